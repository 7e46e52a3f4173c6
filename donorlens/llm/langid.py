"""Language identification by cross-parsing entropy.

Per language a suffix automaton of labelled text is built. A document is parsed
against each automaton into the longest strings that occur in that language's
text; the fewer phrases per character (times log2 of the training length, the
cost of naming one), the lower the cross entropy, and the language with the
lowest wins. Letters are lower-cased, everything between letters counts as one
blank, so markup says nothing about the language.

Fit: at most ``SAMPLE_DOCS`` documents a language (smallest hashes of doc_id, so
a source holding a third of all rows gets a third) and ``SAMPLE_CHARS``
characters of them, in windows from hashed places all over each text (the head of a
page is often not its own); this is what the driver holds, times the number of languages.
Prediction: one narrow pass over whole texts; the automata are dense tables and all
text runs of a batch are parsed in lockstep by numpy. Runs of ``RUN`` characters are
parsed on their own, for all languages alike.

The tables go to the workers in shards of at most ``SHARD_BYTES`` (one language at
least), so what is broadcast has a bound whatever the number of languages. More
shards mean more passes: each stores its two cheapest languages of every distinct
text (by two 64-bit hashes), and the cheapest of all shards wins.

Defined results: a null text or one without a letter is ``und`` with score 0;
ties go to the first language by name; without training text all are ``und``;
null doc_ids are carried and not learned from; repeated rows give repeated rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from donorlens.llm.common import exactly, stage

SAMPLE_DOCS = 64
SAMPLE_CHARS = 20_000
LETTERS = 96       # classes of the most frequent training letters; others share SPARE classes
SPARE = 31
RUN = 256
WINDOW = 64        # letters in a row that the sample takes of a long text, about
SHARD_BYTES = 256 << 20
FOLDS, HELD_OUT = 5, 0


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def code_points(text: str | None) -> np.ndarray:
    """Lower-cased letters as code points; each stretch of anything else is one 0."""
    if not text:
        return np.zeros(0, dtype=np.uint32)
    codes = np.frombuffer(text.lower().encode("utf-32-le"), "<u4")
    codes = np.where(_is_letter()[codes], codes, np.uint32(0))
    return codes[np.r_[True, (codes[1:] != 0) | (codes[:-1] != 0)]]


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """Transition table (states x width) of the automaton of all substrings; -1: no such string."""
    table = np.full((2 * len(symbols) + 2, width), -1, dtype=np.int32)
    link, length = [-1], [0]
    last = 0
    for c in symbols:
        now = len(length)
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and table[p, c] < 0:
            table[p, c] = now
            p = link[p]
        if p >= 0:
            q = int(table[p, c])
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                table[copy] = table[q]
                while p >= 0 and table[p, c] == q:
                    table[p, c] = copy
                    p = link[p]
                link[q] = link[now] = copy
        last = now
    return table[:len(length)]


@dataclass
class Model:
    languages: list[str]
    classes: np.ndarray   # code point -> class, for code points below its length
    spare: int            # first of the shared classes
    width: int
    step: np.ndarray      # flat: (state * width + class) -> next state * width * 4 + phrases that end here
    roots: np.ndarray     # per language, state * width
    cost: np.ndarray      # per language, log2 of its training length


def drawn(codes: np.ndarray, budget: int) -> np.ndarray:
    """At most ``budget`` characters: the whole text, or one window from a hashed place in each of as many
    equal stretches as windows fit. A 0 stands before each."""
    if len(codes) < budget:
        return np.r_[np.uint32(0), codes]
    n = max(1, budget // (WINDOW + 1))
    size = budget // n - 1
    edges = np.arange(n + 1) * len(codes) // n
    seed = xxhash.xxh64_intdigest(codes.tobytes())
    parts = []
    for i, (a, b) in enumerate(zip(edges.tolist(), edges[1:].tolist())):
        at = a + xxhash.xxh64_intdigest(i.to_bytes(8, "little"), seed) % max(1, b - a - size + 1)
        parts += [np.zeros(1, np.uint32), codes[at:at + size]]
    return np.concatenate(parts)


def fit(samples: dict[str, list[str | None]], sample_chars: int = SAMPLE_CHARS,
        shard_bytes: int | None = None) -> Iterator[Model]:
    """The shards, by language name, one made after the other; none without training text."""
    shard_bytes = SHARD_BYTES if shard_bytes is None else shard_bytes
    texts = {}
    for lang in sorted(samples):
        parts = [c for c in (code_points(t) for t in samples[lang]) if c.any()]
        if not parts:
            continue
        each = max(2, sample_chars // len(parts))
        short = sum(max(0, each - 1 - len(p)) for p in parts)
        long = sum(len(p) >= each for p in parts)
        each += short // long if long else 0  # what short documents leave goes to the long ones
        texts[lang] = np.concatenate([drawn(p, each) for p in parts])[:sample_chars]
    if not texts:
        return
    seen, counts = np.unique(np.concatenate(list(texts.values())), return_counts=True)
    order = [c for _, c in sorted(zip((-counts).tolist(), seen.tolist())) if c][:LETTERS]
    spare = len(order) + 1
    width = spare + SPARE + 1  # the last class pads runs
    classes = np.zeros(max(order) + 1, dtype=np.int32)
    classes[order] = np.arange(1, len(order) + 1)
    shard = Model([], classes, spare, width, np.zeros(0), np.zeros(0), np.zeros(0))
    tables, roots, base = [], [], 0

    def made() -> Model:
        cost = np.array([max(1.0, np.log2(len(texts[lang]))) for lang in shard.languages])
        return replace(shard, step=np.concatenate(tables), roots=np.array(roots), cost=cost)

    for lang in sorted(texts):
        table = suffix_automaton(_classify(shard, texts[lang]).tolist(), width)
        base_size = len(table) * width
        if tables and 4 * (base + base_size) > shard_bytes:
            yield made()
            shard, tables, roots, base = replace(shard, languages=[]), [], [], 0
        again = np.maximum(table[0], 0)  # a new phrase starts with the symbol that ended the last
        ends = table < 0
        unknown = ends & (table[0] < 0)[None, :]  # occurs nowhere: a phrase of its own behind the one it ends
        nxt = np.where(ends, again[None, :], table).astype(np.int64) * width + base
        ended = ends.astype(np.int64) + unknown
        ended[0, table[0] < 0] = 1  # at the root no phrase was open
        nxt[:, width - 1], ended[:, width - 1] = base, 1  # padding ends the open phrase
        ended[0, width - 1] = 0
        step = nxt * 4 + ended
        tables.append(step.reshape(-1).astype(np.int32 if 4 * (base + base_size) < 2**31 else np.int64))
        roots.append(base)
        shard.languages.append(lang)
        base += base_size
    yield made()


def _classify(model: Model, codes: np.ndarray) -> np.ndarray:
    inside = np.minimum(codes, len(model.classes) - 1)
    found = np.where(codes < len(model.classes), model.classes[inside], 0)
    return np.where((found == 0) & (codes != 0), model.spare + codes % SPARE, found).astype(np.int32)


def phrases(model: Model, docs: list[np.ndarray]) -> np.ndarray:
    """(documents x languages) number of phrases of each document's class sequence."""
    n_runs = np.array([-(-len(d) // RUN) for d in docs], dtype=np.int64)
    owner = np.repeat(np.arange(len(docs)), n_runs)
    out = np.zeros((len(docs), len(model.languages)), dtype=np.int64)
    if not len(owner):
        return out
    grid = np.full((len(owner), RUN), model.width - 1, dtype=np.int32)
    at = 0
    for d, n in zip(docs, n_runs):
        grid[at:at + n].reshape(-1)[:len(d)] = d
        at += n
    columns = np.ascontiguousarray(grid.T)
    state = np.repeat(model.roots[:, None], len(owner), axis=1).astype(model.step.dtype)
    count = np.zeros(state.shape, dtype=np.int32)
    for column in columns:
        got = model.step.take(state + column)
        count += (got & 3).astype(np.int32)
        state = got >> 2
    count += state != model.roots[:, None]  # the phrase a run ends in
    np.add.at(out, owner, count.T)
    return out


def cheapest(model: Model, texts: list[str | None]) -> list[tuple[float | None, str | None, float | None]]:
    """Per text the least cost, its language and the next cost (None: no letter, or no other language)."""
    codes = [code_points(t) for t in texts]
    found = phrases(model, [_classify(model, c) for c in codes])
    bits = found * model.cost
    best = bits.argmin(axis=1)
    out = []
    for i, c in enumerate(codes):
        if not c.any():
            out.append((None, None, None))
            continue
        rest = np.delete(bits[i], best[i])
        out.append((float(bits[i, best[i]]), model.languages[best[i]], float(rest.min()) if len(rest) else None))
    return out


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def training_sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> dict[str, list[str]]:
    """At most ``sample_docs`` texts a language, one a doc_id: ids are ranked without the texts (each task
    keeps its smallest hashes), then only the chosen documents' texts are read."""
    rows = exactly(docs, "doc_id", "lang").where("doc_id IS NOT NULL AND lang IS NOT NULL").where(~held_out(F.col("doc_id")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    once = rows.groupBy("lang", "doc_id").agg(F.count(F.lit(1)))
    chosen = once.withColumn("_r", rank).where(F.col("_r") <= sample_docs).select("doc_id", "lang")
    picked = (exactly(docs, "doc_id", "text", "lang").join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi")
              .groupBy("doc_id", "lang").agg(F.min("text").alias("text")).orderBy(F.xxhash64("doc_id"), "doc_id"))
    out: dict[str, list[str]] = {}
    for r in picked.collect():  # sample_docs a language
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def _costs(docs: DataFrame, model: Model, keys: str) -> DataFrame:
    """``docs`` (key columns, then the text) with the text replaced by low, lang and next."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns[:-1] + ["low", "lang", "next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                got = cheapest(shared.value, part.column(part.num_columns - 1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array([g[0] for g in got], pa.float64()),
                     pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.float64())], names=names)

    return docs.mapInArrow(run, f"{keys}, low double, lang string, next double")


def identify(docs: DataFrame, models: Iterable[Model]) -> DataFrame:
    """doc_id, lang_pred, score; only the text is looked at."""
    texts = exactly(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    models = iter(models)
    model, more = next(models, None), next(models, None)
    if model is None:
        found = texts.selectExpr("doc_id", "CAST(NULL AS DOUBLE) AS low", "CAST(NULL AS STRING) AS lang",
                                 "CAST(NULL AS DOUBLE) AS next")
    elif more is None:
        found = _costs(texts, model, "doc_id long")
    else:
        keys = ["xxhash64(text) AS h1", "xxhash64('second', text) AS h2"]
        once, every = ["low", "lang", "next"], None
        while model is not None:
            costs = _costs(texts.selectExpr(*keys, "text"), model, "h1 long, h2 long")
            part = stage(costs.groupBy("h1", "h2").agg(*[F.first(c).alias(c) for c in once]), "language-costs")
            every = part if every is None else every.union(part)
            model, more = more, next(models, None)
        # a row a shard and text; the next cost of all is the winner's next or another shard's least
        ranked = every.where("lang IS NOT NULL").groupBy("h1", "h2").agg(
            F.sort_array(F.collect_list(F.struct("low", "lang", "next"))).alias("r"))
        best = ranked.selectExpr("h1", "h2", "r[0].low AS low", "r[0].lang AS lang",
                                 "least(r[0].next, get(r, 1).low) AS next")
        found = texts.selectExpr("doc_id", *keys).join(best, ["h1", "h2"], "left")
    return found.selectExpr(
        "doc_id", "coalesce(lang, 'und') AS lang_pred",
        "CASE WHEN lang IS NULL THEN 0.0D WHEN next IS NULL THEN 1.0D ELSE next / (next + low) END AS score")


def query(docs: DataFrame) -> DataFrame:
    found = identify(docs, fit(training_sample(docs)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
