"""Toxicity by a counterfactually regularised classifier.

A logistic model over the presence of words and the frequency of word beginnings
(an inflected word has one stem and many endings, each of them rare). Besides the
usual loss it is penalised for changing its score when an identity term in a labelled text is
swapped for another of its group, so a neutral mention of a group cannot carry a
score and one group's term cannot weigh more than another's.

Fit: about ``TRAIN_DOCS`` labelled documents (by hash of doc_id; the bound is
the parameter), each distinct text once. Term statistics are grouped in Spark. A
term becomes a feature only if its presence differs between the classes by more
than chance would have it for any of the terms tested, and it stands in different
surroundings in at least ``CONTEXT_SHARE`` of the texts of the class it speaks for:
terms that merely sit in many near copies of one text do not. All floors follow
the sample's size. Beginnings of identity terms are no features, so that the
penalty cannot be evaded through them. The design matrix (chosen terms only) is
what the driver fits. Scoring is one narrow pass over whole texts.

Defined results: a null or empty text gets the score of a text without any known
word; null labels and labels without a document are not used; a document with
several labels counts as toxic if one says so; without training rows every score
is 0; null doc_ids are carried and not learned from; repeated rows are repeated.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from donorlens.llm.common import exactly, stage

TRAIN_DOCS = 12_000
PREFIXES = range(4, 9)   # lengths of the word beginnings, written with a final *
FULL_RATE = 0.01         # share of a text's words from which a beginning counts in full
TERM_SHARE = 0.1         # features per training text at most
DOC_SHARE, LEAST_DOCS = 0.01, 3          # texts a term stands in: share of the smaller class, and the least
CONTEXT_SHARE, LEAST_CONTEXTS = 0.5, 2   # different surroundings: share of those texts, and the least
CHANCE = 0.05            # of any feature at all, were the labels dealt at random
FLUSH = 200_000          # terms that a task counts before it passes them on
RIDGE = 0.0002       # on the mean loss: one strong word must be able to outweigh the bias of noisy labels
FAIRNESS = 5.0       # weight of the swap penalty
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1

# Identity terms by group; a term may be swapped for any other of its group.
IDENTITY_GROUPS = [
    ["women", "men", "girls", "boys"],
    ["woman", "man", "girl", "boy"],
    ["christians", "muslims", "jews", "hindus", "buddhists", "atheists"],
    ["christian", "muslim", "jewish", "hindu", "buddhist", "atheist"],
    ["black", "white", "asian", "latino", "arab", "african", "european"],
    ["gay", "lesbian", "straight", "bisexual", "transgender", "queer"],
    ["immigrants", "refugees", "foreigners", "natives"],
    ["disabled", "deaf", "blind", "autistic"],
    ["frauen", "männer", "juden", "christen", "muslime"],
    ["femmes", "hommes", "juifs", "chrétiens", "musulmans"],
    ["mujeres", "hombres", "judíos", "cristianos", "musulmanes"],
]
_TOKEN = re.compile(r"\w+")


def words(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def beginnings(word: str) -> list[str]:
    return [word[:k] + "*" for k in PREFIXES if k <= len(word)]


class Terms:
    """Values of known terms in a text: 1 for a word that occurs, for a beginning its frequency up to ``FULL_RATE``."""

    def __init__(self, terms: Iterable[str]):
        terms = set(terms)
        self.whole = {t for t in terms if not t.endswith("*")}
        self.starts = terms - self.whole
        self.heads = {t[:PREFIXES[0]] for t in self.starts}

    def of_word(self, word: str) -> list[str]:
        found = [word] if word in self.whole else []
        if word[:PREFIXES[0]] in self.heads:
            found += [b for b in beginnings(word) if b in self.starts]
        return found

    def values(self, text: str | None) -> dict[str, float]:
        found = words(text)
        counts = Counter(found)
        out = dict.fromkeys(self.whole & counts.keys(), 1.0)
        rates: Counter = Counter()
        for w in counts:
            if w[:PREFIXES[0]] in self.heads:
                for b in beginnings(w):
                    if b in self.starts:
                        rates[b] += counts[w]
        out.update((b, min(1.0, n / len(found) / FULL_RATE)) for b, n in rates.items())
        return out


class Model:
    def __init__(self, bias: float, weights: dict[str, float]):
        self.bias, self.weights, self.terms = bias, weights, Terms(weights)

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weights[t] * v for t, v in sorted(self.terms.values(text).items()))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """(id, toxic, text) of about ``train_docs`` labelled documents outside the held-out fold. Staged.

    Rows are chosen by doc_id before any text is read, so the texts of the others never move.
    """
    ids = (exactly(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
           .where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    n = ids.count()
    share = min(1.0, train_docs / n) if n else 1.0
    chosen = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    picked = exactly(docs, "doc_id", "text").where("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    once = picked.groupBy(F.xxhash64("text").alias("id")).agg(F.max("toxic").alias("toxic"), F.first("text").alias("text"))
    return stage(once, "toxicity-training")


def choose_terms(rows: DataFrame, n_toxic: int, n_clean: int, barred: Iterable[str] = ()) -> list[str]:
    """Words and beginnings whose presence tells the classes apart, best first."""
    names = ["term", "toxic", "n"]

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def passed_on() -> Iterator[pa.RecordBatch]:
            for toxic, c in enumerate(counts):
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array([toxic] * len(c), pa.int32()),
                                                  pa.array(list(c.values()), pa.int64())], names=names)
                c.clear()

        for batch in batches:
            for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = set(words(text))
                counts[toxic > 0].update(found | {w[:k] + "*" for k in PREFIXES for w in found if k <= len(w)})
                if sum(map(len, counts)) > FLUSH:
                    yield from passed_on()
        yield from passed_on()

    seen = rows.select("toxic", "text").mapInArrow(presence, "term string, toxic int, n long")
    stats = stage(seen.groupBy("term").agg(
        *[F.coalesce(F.sum(F.when(F.col("toxic") == c, F.col("n"))), F.lit(0)).alias(f"docs{c}") for c in (0, 1)]),
        "toxicity-terms")
    n_terms = max(1, stats.count())
    a, b = F.col("docs1").cast("double"), F.col("docs0").cast("double")
    n = n_toxic + n_clean
    off = a * (n_clean - b) - b * (n_toxic - a)
    scale = (a + b) * (n - a - b) * n_toxic * n_clean
    strong = (stats.where((a + b) >= max(LEAST_DOCS, DOC_SHARE * min(n_toxic, n_clean)))
              .withColumn("chi2", F.when(scale > 0, n * off * off / scale).otherwise(0.0))
              .where(F.col("chi2") >= 2 * log(n_terms / CHANCE))
              .select("term", "chi2", (off > 0).cast("int").alias("speaks"),
                      F.when(off > 0, F.col("docs1")).otherwise(F.col("docs0")).alias("docs")))
    best = {r["term"]: r for r in strong.collect()}  # of a bounded sample of texts
    for t in barred:
        best.pop(t, None)
    shared = rows.sparkSession.sparkContext.broadcast((Terms(best), {t: r["speaks"] for t, r in best.items()}))

    def surroundings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, speaks = shared.value
        for batch in batches:
            out = {}
            for i, (toxic, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                found = words(text)
                for a, w, b in zip(["", *found], found, [*found[1:], ""]):
                    for t in terms.of_word(w):
                        if speaks[t] == toxic:
                            out[i, t] = a, b
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for _, t in out], pa.string()),
                 pa.array([xxhash.xxh64_intdigest(" ".join(c)) >> 1 for c in out.values()], pa.int64())],
                names=["term", "around"])

    around = rows.select("toxic", "text").mapInArrow(surroundings, "term string, around long")
    contexts = {r["term"]: r["n"] for r in around.distinct().groupBy("term").agg(F.count(F.lit(1)).alias("n")).collect()}
    passed = [t for t, r in best.items() if contexts.get(t, 0) >= max(LEAST_CONTEXTS, CONTEXT_SHARE * r["docs"])]
    return sorted(passed, key=lambda t: (-best[t]["chi2"], t))[:max(1, int(TERM_SHARE * n))]


def swap_penalty(terms: list[str], mentions: np.ndarray, groups: list[list[str]]) -> np.ndarray:
    """Quadratic form Q over the weights: w'Qw is the mean squared score change when each mentioned
    identity term is swapped for the others of its group. ``mentions``: share of the labelled texts
    that mention each term."""
    at = {t: i for i, t in enumerate(terms)}
    q = np.zeros((len(terms), len(terms)))
    for group in groups:
        inside = [at[t] for t in group if t in at]
        for i in inside:
            for j in inside:
                if i != j:
                    share = mentions[i] / max(1, len(inside) - 1)
                    q[i, i] += share
                    q[j, j] += share
                    q[i, j] -= share
                    q[j, i] -= share
    return q


def fit_weights(x: np.ndarray, y: np.ndarray, penalty: np.ndarray, ridge: float = RIDGE, steps: int = 50) -> np.ndarray:
    """Weights (bias last) of the penalised logistic loss, by Newton steps."""
    design = np.c_[x, np.ones(len(x))]
    k = design.shape[1]
    q = np.zeros((k, k))
    q[:-1, :-1] = penalty + ridge * np.eye(k - 1)
    w = np.zeros(k)

    def loss(v):
        z = design @ v
        return np.mean(np.logaddexp(0, z) - y * z) + v @ q @ v / 2

    now = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-design @ w))
        gradient = design.T @ (p - y) / len(y) + q @ w
        hessian = (design * (p * (1 - p))[:, None]).T @ design / len(y) + q + 1e-9 * np.eye(k)
        move, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-4 and loss(w - size * move) > now:
            size /= 2
        w = w - size * move
        was, now = now, loss(w)
        if was - now < 1e-9:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train_docs: int = TRAIN_DOCS,
        groups: list[list[str]] | None = None) -> Model | None:
    groups = IDENTITY_GROUPS if groups is None else groups
    rows = training_rows(docs, labels, train_docs)
    count = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = count.get(1, 0), count.get(0, 0)
    if not n_toxic or not n_clean:
        return None
    identity = {t for g in groups for t in g}
    barred = identity.union(*map(beginnings, identity))
    terms = [*sorted(identity), *choose_terms(rows, n_toxic, n_clean, barred)]
    at = {t: i for i, t in enumerate(terms)}
    known = Terms(terms)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [sorted((at[w], v) for w, v in known.values(t).items()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([[i for i, _ in g] for g in got], pa.list_(pa.int32())),
                 pa.array([[v for _, v in g] for g in got], pa.list_(pa.float64()))], names=["toxic", "cells", "values"])

    # a bounded sample: about train_docs rows of a few known terms each
    found = rows.select("toxic", "text").mapInArrow(encode, "toxic int, cells array<int>, values array<double>").collect()
    x = np.zeros((len(found), len(terms)), dtype=np.float64)
    for i, r in enumerate(found):
        x[i, r["cells"]] = r["values"]
    y = np.array([r["toxic"] for r in found], dtype=np.float64)
    w = fit_weights(x, y, FAIRNESS * swap_penalty(terms, x.mean(axis=0), groups))
    return Model(float(w[-1]), {t: float(v) for t, v in zip(terms, w) if v})


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, score; only the text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            got = [model.score(t.as_py()) if model else 0.0 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], names=["doc_id", "score"])

    texts = exactly(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return texts.mapInArrow(run, "doc_id long, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
