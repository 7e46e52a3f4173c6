"""Quality classifier by co-training of two views.

The *content* view sees measurements of the text, the *metadata* view the page's
source, language and length. Each view is a logistic model fitted on the labelled
documents; over ``ROUNDS`` rounds each labels the unlabelled documents it is most
sure of for the other one. At the end each view's score is calibrated (Platt)
on labelled documents kept apart for that, and a logistic combination of the
two calibrated log-odds scores every document.

One pass over whole texts computes the measurements, which are written down;
fitting reads a bounded sample of them (``LABELLED`` + ``POOL`` rows by hash of
doc_id) and scoring reads them all. Sources are hashed into ``SOURCE_CELLS``
cells, so the metadata view does not grow with the number of sources.

Defined results: null texts measure as empty ones; null metadata is a value of
its own; null labels are not used; a document with several labels counts as good
only if all say so; without labels of both kinds every score is 0.5; null
doc_ids are carried; repeated rows are repeated; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from donorlens.llm.common import exactly, stage
from donorlens.llm.toxicity import fit_weights

LABELLED, POOL = 12_000, 12_000
ROUNDS = 5
SHARE = 0.05         # of the pool that each view labels per round, half of it per class
SURE = 0.9           # a pseudo-label's least confidence
SOURCE_CELLS, LANG_CELLS, LENGTH_CELLS = 64, 16, 24
FOLDS, HELD_OUT = 5, 0
N_CONTENT = 12
_SYMBOL = re.compile(r"[#*$%&|<>{}\[\]\\^~=_]")


def content(text: str | None) -> list[float]:
    """Measurements of one whole text, most of them shares between 0 and 1."""
    text = text or ""
    words = text.split()
    n = max(1, len(words))
    distinct = len(set(words))
    chars = sum(map(len, words))
    lines = [x for x in text.split("\n") if x.strip()]
    pairs = len(set(zip(words, words[1:])))
    return [
        np.log1p(len(words)) / 10,
        distinct / n,
        np.log1p(distinct) / np.log1p(n),
        pairs / max(1, len(words) - 1),
        chars / n / 10,
        min(2.0, len(_SYMBOL.findall(text)) / n),
        sum(map(str.isupper, words)) / n,
        min(2.0, text.count("!") / n),
        min(2.0, (text.count(".") + text.count(",")) / n),
        sum(map(str.isdigit, words)) / n,
        len(set(lines)) / max(1, len(lines)),
        min(2.0, text.count("|") / n),
    ]


def _cell(value, cells: int) -> int:
    return 0 if value is None else 1 + xxhash.xxh64_intdigest(str(value)) % (cells - 1)


def metadata(source, lang, n_chars) -> list[int]:
    """Cells of the one-hot metadata view."""
    length = 0 if n_chars is None else 1 + min(LENGTH_CELLS - 2, max(0, int(n_chars)).bit_length())
    return [_cell(source, SOURCE_CELLS), SOURCE_CELLS + _cell(lang, LANG_CELLS), SOURCE_CELLS + LANG_CELLS + length]


N_META = SOURCE_CELLS + LANG_CELLS + LENGTH_CELLS


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, content array, meta array), staged: the only pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([content(t.as_py()) for t in batch.column(1)], pa.list_(pa.float64())),
                 pa.array([metadata(*m) for m in zip(*cols)], pa.list_(pa.int32()))],
                names=["doc_id", "content", "meta"])

    rows = exactly(docs, "doc_id", "text", "source", "lang", "n_chars").selectExpr(
        "CAST(doc_id AS BIGINT) AS doc_id", "text", "source", "lang", "CAST(n_chars AS BIGINT) AS n_chars")
    return stage(rows.mapInArrow(run, "doc_id long, content array<double>, meta array<int>"), "quality-features")


@dataclass
class View:
    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return np.clip(z @ self.weights[:-1] + self.weights[-1], -30, 30)


def _fit_view(x: np.ndarray, y: np.ndarray, ridge: float) -> View:
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    k = x.shape[1]
    return View(fit_weights((x - mean) / scale, y, np.zeros((k, k)), ridge), mean, scale)


def _design(rows: list) -> tuple[np.ndarray, np.ndarray]:
    a = np.array([r["content"] for r in rows], dtype=np.float64).reshape(-1, N_CONTENT)
    a = np.c_[a, a ** 2]
    b = np.zeros((len(rows), N_META))
    for i, r in enumerate(rows):
        b[i, r["meta"]] = 1
    return a, b


@dataclass
class Model:
    views: tuple[View, View]
    platt: list[tuple[float, float]]
    combine: np.ndarray

    def score(self, rows: list) -> np.ndarray:
        z = [a * v.logit(x) + b for v, x, (a, b) in zip(self.views, _design(rows), self.platt)]
        return 1 / (1 + np.exp(-np.clip(np.c_[z[0], z[1], np.ones(len(rows))] @ self.combine, -30, 30)))


def co_train(labelled: tuple, y: np.ndarray, pool: tuple, rounds: int = ROUNDS) -> tuple[View, View]:
    """Both views after exchanging confident pseudo-labels. ``labelled`` and ``pool`` hold one design
    matrix per view over the same rows."""
    ridge = (0.001, 0.01)
    own = [(x, y) for x in labelled]
    free = np.ones(len(pool[0]), dtype=bool)
    views = [_fit_view(x, t, r) for (x, t), r in zip(own, ridge)]
    each = max(1, int(len(free) * SHARE / 2))
    for _ in range(rounds):
        chosen = []
        for k, view in enumerate(views):
            p = 1 / (1 + np.exp(-view.logit(pool[k])))
            for value, sure in ((1.0, p), (0.0, 1 - p)):
                ready = np.flatnonzero(free & (sure >= SURE))
                best = ready[np.argsort(-sure[ready], kind="stable")[:each]]
                chosen.append((1 - k, best, value))
        if not any(len(c[1]) for c in chosen):
            break
        for k, rows, value in chosen:
            x, t = own[k]
            own[k] = (np.r_[x, pool[k][rows]], np.r_[t, np.full(len(rows), value)])
            free[rows] = False
        views = [_fit_view(x, t, r) for (x, t), r in zip(own, ridge)]
    return views[0], views[1]


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def _sample(rows: DataFrame, limit: int) -> list:
    """About ``limit`` documents by hash of doc_id, one row each, in a fixed order."""
    n = rows.select("doc_id").distinct().count()
    share = min(1.0, limit / n) if n else 1.0
    chosen = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    once = chosen.groupBy("doc_id").agg(F.min(F.struct("content", "meta", "quality")).alias("r")).select("doc_id", "r.*")
    return sorted(once.collect(), key=lambda r: r["doc_id"])


def fit(measured: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL) -> Model | None:
    marks = (exactly(labels, "doc_id", "quality").where("doc_id IS NOT NULL AND quality IS NOT NULL")
             .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality")))
    rows = measured.where("doc_id IS NOT NULL").where(~held_out(F.col("doc_id"))).join(marks, "doc_id", "left")
    known = _sample(rows.where("quality IS NOT NULL"), labelled)
    apart = [r for r in known if xxhash.xxh64_intdigest(str(r["doc_id"]), 7) % 4 == 0]   # for calibration
    train = [r for r in known if xxhash.xxh64_intdigest(str(r["doc_id"]), 7) % 4 != 0]
    y, y_apart = (np.array([float(r["quality"] > 0) for r in part]) for part in (train, apart))
    if not len(y) or y.min() == y.max() or not len(y_apart) or y_apart.min() == y_apart.max():
        return None
    free = _sample(rows.where("quality IS NULL"), pool)
    views = co_train(_design(train), y, _design(free))
    platt, logits = [], []
    for view, x in zip(views, _design(apart)):
        z = view.logit(x)
        a, b = fit_weights(z[:, None], y_apart, np.zeros((1, 1)), 1e-4)
        platt.append((float(a), float(b)))
        logits.append(a * z + b)
    combine = fit_weights(np.c_[logits[0], logits[1]], y_apart, np.zeros((2, 2)), 1e-3)
    return Model(views, platt, combine)


def score(measured: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) for every measured document."""
    shared = measured.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"content": c, "meta": m} for c, m in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            got = shared.value.score(rows) if shared.value and rows else np.full(len(rows), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.float64())], names=["doc_id", "score"])

    return measured.select("doc_id", "content", "meta").mapInArrow(run, "doc_id long, score double")


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    measured = features(docs)
    return score(measured, fit(measured, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).alias("kept"))
