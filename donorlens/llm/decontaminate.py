"""Benchmark decontamination: BM25 over the test items with block-max WAND.

The inverted index holds the benchmark items, not the corpus. Its statistics
(document frequencies, lengths) are computed by Spark over all items; the
postings go to the workers in shards of at most ``SHARD_WORDS`` words each, so
what is broadcast has a bound whatever the benchmark's size (more shards mean
more passes over the documents, each a narrow scan without a shuffle).

Every training document is cut into overlapping passages (twice the longest
item, stepping by one item length, so every place an item could stand lies
whole inside a passage) and each passage is a query:

* impacts are BM25 weights divided by the item's own score, so one threshold
  (``RETRIEVE``) asks for the same share of every item;
* items stand in blocks. Every rarer term of a passage has a cursor on its list of
  blocks. The cursors are sorted by block and their term maxima added up: the
  block at which the sum can reach the threshold is the pivot. The cursors before it
  jump to it by binary search, their *block* maxima there decide whether the block is
  scored, and the cursors go on behind it. All passages of a slice take their steps
  together, so a step is a few array operations, and a slice holds about ``WORDS`` words;
* frequent terms have no cursors: together they add at most the largest share that
  any item of a block owes to them. A block that could reach the threshold by its
  frequent terms alone is scored for every passage;
* in a block that is left every item is scored exactly and all at or above
  the threshold are retrieved, not only the best;
* a retrieved item counts as leaked if at least ``OVERLAP`` of the five-word
  shingles of its question and of its answer stand in the passage. Tables may
  bring ``question`` and ``answer`` columns; otherwise the last sentence of
  ``text`` is the answer and what stands before it the question (one sentence:
  both are the whole).

Defined results: null or empty texts and items match nothing; equal items are all
reported; rows that share a doc_id are judged one by one; a null doc_id is
carried; extra columns pass through; an empty benchmark leaves every document; a very
long text is searched in overlapping slices, so only its word numbers are held whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from donorlens.llm.common import exactly, stage

K1, B = 1.2, 0.75
RETRIEVE = 0.6       # share of an item's own BM25 score a passage must reach
OVERLAP = 0.8        # share of the question's and of the answer's shingles
SHINGLE = 5
BLOCK = 8            # items in a block
FREQUENT = 0.03      # share of the items from which a term counts as frequent
SHARD_WORDS = 2_000_000
WORDS = 100_000      # words of the passages searched together
LONG_TEXT = 1 << 20  # characters from which a text's words are read one at a time
EPS = 1e-9
_TOKEN = re.compile(r"\w+")
_SENTENCE = re.compile(r"(?<=[.!?\n])\s+(?=\S)")
PAIRS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall(text.lower()) if text else []


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    parts = [t for t in map(tokens, _SENTENCE.split(text or "")) if t]
    if len(parts) < 2:
        whole = parts[0] if parts else []
        return whole, whole
    return [w for p in parts[:-1] for w in p], parts[-1]


def _grams(ids: list, n: int) -> set[tuple]:
    return {tuple(ids[i:i + n]) for i in range(len(ids) - n + 1)}


@dataclass
class Index:
    """One shard: postings by term as (block, block maximum) and (item, impact) runs."""

    vocab: dict[str, int]
    items: list[int | None]
    parts: list[tuple[set, int, set, int]]       # question shingles and their length, answer's
    longest: int
    n_blocks: int
    block_at: np.ndarray                          # term -> run of its blocks
    block_id: np.ndarray
    block_max: np.ndarray
    item_at: np.ndarray                           # run of blocks -> run of its items
    item_id: np.ndarray
    impact: np.ndarray
    rare: np.ndarray                              # term -> it has a cursor
    frequent_share: np.ndarray                    # block -> bound of what frequent terms add
    block_key: np.ndarray                         # term * n_blocks + block, ascending
    term_max: np.ndarray                          # term -> its largest block maximum


def build_index(rows: list, frequency: dict[str, int], n_items: int, mean_length: float) -> Index:
    """``rows``: (item_id, question tokens, answer tokens, all tokens) of one shard."""
    vocab: dict[str, int] = {}
    postings, parts = [], []
    for k, (_, question, answer, words) in enumerate(rows):
        count: dict[str, int] = {}
        for w in words:
            count[w] = count.get(w, 0) + 1
        norm = K1 * (1 - B + B * len(words) / max(mean_length, 1e-9))
        weight = {w: np.log1p((n_items - frequency[w] + 0.5) / (frequency[w] + 0.5)) * n * (K1 + 1) / (n + norm)
                  for w, n in count.items()}
        own = sum(weight.values())
        postings += [(vocab.setdefault(w, len(vocab)), k // BLOCK, k, x / own) for w, x in weight.items()]
        ids = [[vocab[w] for w in p] for p in (question, answer)]
        sizes = [min(SHINGLE, len(p)) for p in ids]
        parts.append((_grams(ids[0], sizes[0]), sizes[0], _grams(ids[1], sizes[1]), sizes[1]))
    table = np.array(sorted(postings), dtype=np.float64).reshape(-1, 4)
    term, block, item = (table[:, i].astype(np.int64) for i in range(3))
    new = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])]) if len(table) else np.zeros(0, int)
    top = np.maximum.reduceat(table[:, 3], new) if len(table) else np.zeros(0)
    rare = np.array([frequency[w] <= max(1, FREQUENT * n_items) for w in vocab], dtype=bool)
    share = np.zeros(-(-len(rows) // BLOCK) * BLOCK)
    np.add.at(share, item[~rare[term]], table[~rare[term], 3])
    n_blocks = -(-len(rows) // BLOCK)
    at = np.searchsorted(term[new], np.arange(len(vocab) + 1))
    return Index(vocab, [r[0] for r in rows], parts, max((len(r[3]) for r in rows), default=1), n_blocks, at, block[new],
                 top, np.r_[new, len(table)], item, table[:, 3], rare, share.reshape(-1, BLOCK).max(axis=1, initial=0),
                 term[new] * n_blocks + block[new], np.maximum.reduceat(top, at[:-1]) if len(table) else np.zeros(0))


def _runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, position) of every position in the runs."""
    size = ends - starts
    owner = np.repeat(np.arange(len(size)), size)
    return owner, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts, size)


def _numbers(index: Index, text: str | None) -> np.ndarray:
    """The term of every word, -1 for words of no item."""
    known = index.vocab.get
    if text and len(text) > LONG_TEXT:
        return np.fromiter((known(m.group(), -1) for m in _TOKEN.finditer(text.lower())), dtype=np.int64)
    return np.fromiter((known(w, -1) for w in tokens(text)), dtype=np.int64)


@dataclass
class Passages:
    """Some passages with their distinct terms."""

    owner: np.ndarray    # passage -> text
    start: np.ndarray    # passage -> its words in ``words``
    end: np.ndarray
    words: np.ndarray
    term_at: np.ndarray  # passage -> run of its distinct terms
    term: np.ndarray


def slices(index: Index, texts: list[str | None], words: int) -> Iterator[Passages]:
    """All passages of the texts, about ``words`` words at a time. With chunks of ``index.longest`` words,
    passage c of a text is its chunks c and c + 1 (a text of one chunk is one passage)."""
    step = index.longest
    most = max(1, words // step)  # passages of a long text that are searched together
    held, size = [], 0
    for i, text in enumerate(texts):
        ids = _numbers(index, text)
        n = max(1, -(-len(ids) // step) - 1)
        for c in range(0, n if len(ids) else 0, most):
            held.append((i, ids[c * step:(c + most + 1) * step]))
            size += len(held[-1][1])
            if size >= words:
                yield _passages(index, held)
                held, size = [], 0
    if held:
        yield _passages(index, held)


def _passages(index: Index, held: list[tuple[int, np.ndarray]]) -> Passages:
    step, n_terms = index.longest, len(index.vocab)
    flat = np.concatenate([ids for _, ids in held])
    size = np.array([len(ids) for _, ids in held])
    count = np.maximum(1, -(-size // step) - 1)
    base, first = np.cumsum(size) - size, np.cumsum(count) - count
    owner, c = _runs(np.zeros_like(count), count)
    start = base[owner] + c * step
    end = np.minimum(start + 2 * step, (base + size)[owner])
    piece, place = _runs(np.zeros_like(size), size)
    chunk, passage = place // step, first[piece]
    front, back = (flat >= 0) & (chunk < count[piece]), (flat >= 0) & (chunk > 0)
    keys = np.unique(np.r_[(passage[front] + chunk[front]) * n_terms + flat[front],
                           (passage[back] + chunk[back] - 1) * n_terms + flat[back]])
    return Passages(np.array([i for i, _ in held])[owner], start, end, flat,
                    np.searchsorted(keys, np.arange(len(start) + 1) * n_terms), keys % n_terms)


def pivots(index: Index, passages: Passages, retrieve: float) -> tuple[np.ndarray, np.ndarray]:
    """(passage, block): the blocks whose maxima can reach the threshold, by block-max WAND."""
    n_blocks = index.n_blocks
    # blocks that frequent terms alone may carry are taken for every passage
    heavy = index.frequent_share >= retrieve - EPS
    found = [(np.repeat(np.arange(len(passages.start)), heavy.sum()), np.tile(np.flatnonzero(heavy), len(passages.start)))]
    need = retrieve - EPS - index.frequent_share[~heavy].max(initial=0)
    passage = np.repeat(np.arange(len(passages.start)), np.diff(passages.term_at))
    live = index.rare[passages.term]
    passage, term = passage[live], passages.term[live]
    at = index.block_at[term]
    while len(at):
        block = index.block_id[at]
        order = np.argsort(passage * n_blocks + block, kind="stable")
        passage, term, at, block = passage[order], term[order], at[order], block[order]
        sums = np.cumsum(index.term_max[term])
        new = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
        group = np.cumsum(np.r_[False, passage[1:] != passage[:-1]])
        reached = np.flatnonzero(sums - np.r_[0, sums][new][group] >= need)
        # the first cursor of a passage with which its sum can reach the threshold
        reached = reached[np.r_[True, group[reached][1:] != group[reached][:-1]]] if len(reached) else reached
        pivot = np.full(len(new), -1)
        pivot[group[reached]] = block[reached]
        goal = pivot[group]
        live = goal >= 0  # the others cannot reach it any more
        passage, term, at, block, goal = passage[live], term[live], at[live], block[live], goal[live]
        behind = np.flatnonzero(block < goal)
        at[behind] = np.searchsorted(index.block_key, term[behind] * n_blocks + goal[behind])
        live = at < index.block_at[term + 1]
        passage, term, at, goal = passage[live], term[live], at[live], goal[live]
        there = index.block_id[at] == goal
        who, group = np.unique(passage[there], return_inverse=True)
        bound = np.bincount(group, weights=index.block_max[at[there]], minlength=len(who))
        block = np.zeros(len(who), np.int64)
        block[group] = goal[there]
        good = (bound + index.frequent_share[block] >= retrieve - EPS) & ~heavy[block]
        found.append((who[good], block[good]))
        at = at + there
        live = at < index.block_at[term + 1]
        passage, term, at = passage[live], term[live], at[live]
    who, block = (np.concatenate(c) for c in zip(*found))
    return who, block


def retrieved(index: Index, passages: Passages, retrieve: float) -> Iterator[tuple[int, int, float]]:
    """(passage, item, score) of all items that reach the threshold, scored exactly."""
    if not index.n_blocks:
        return
    who, block = pivots(index, passages, retrieve)
    some = max(1, WORDS // (2 * index.longest))
    for i in range(0, len(who), some):
        w, b = who[i:i + some], block[i:i + some]
        pair, at = _runs(passages.term_at[w], passages.term_at[w + 1])
        key = passages.term[at] * index.n_blocks + b[pair]
        run = np.minimum(np.searchsorted(index.block_key, key), len(index.block_key) - 1)
        hit = index.block_key[run] == key
        pair, run = pair[hit], run[hit]
        k, posting = _runs(index.item_at[run], index.item_at[run + 1])
        cell = pair[k] * BLOCK + index.item_id[posting] - b[pair[k]] * BLOCK
        scores = np.bincount(cell, weights=index.impact[posting], minlength=len(w) * BLOCK)
        for cell in np.flatnonzero(scores >= retrieve - EPS).tolist():
            yield int(w[cell // BLOCK]), int(b[cell // BLOCK] * BLOCK + cell % BLOCK), float(scores[cell])


def search(index: Index, texts: list[str | None], retrieve: float = RETRIEVE,
           overlap: float = OVERLAP) -> list[list[tuple]]:
    """Per text the leaked items: (item_id, score, question overlap, answer overlap)."""
    found: list[dict[int, tuple]] = [{} for _ in texts]
    for passages in slices(index, texts, WORDS):
        for passage, k, score in retrieved(index, passages, retrieve):
            words = passages.words[passages.start[passage]:passages.end[passage]].tolist()
            question, n_q, answer, n_a = index.parts[k]
            q = len(question & _grams(words, n_q)) / len(question)
            a = len(answer & _grams(words, n_a)) / len(answer)
            if q >= overlap and a >= overlap:
                mine = found[passages.owner[passage]]
                mine[k] = max(mine.get(k, (score, q, a)), (score, q, a))
    return [[(index.items[k], *v) for k, v in sorted(f.items())] for f in found]


def shards(benchmark: DataFrame, shard_words: int = SHARD_WORDS) -> Iterator[Index]:
    """The benchmark's index, one bounded shard after the other."""
    given = "question" in benchmark.columns and "answer" in benchmark.columns
    rows = exactly(benchmark, "item_id", "question", "answer") if given else exactly(benchmark, "item_id", "text")

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            parts = [(tokens(q), tokens(a)) for q, a in zip(cols[1], cols[2])] if given else \
                [question_and_answer(t) for t in cols[1]]
            whole = [q if q == a else q + a for q, a in parts]
            both = [(q or a, a or q) for q, a in parts]  # a missing part is the other one
            kind = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array([p[0] for p in both], kind),
                 pa.array([p[1] for p in both], kind), pa.array(whole, kind)],
                names=["item_id", "question", "answer", "words"])

    rows = rows.withColumn("item_id", F.col("item_id").cast("long"))
    items = stage(rows.mapInArrow(split, "item_id long, question array<string>, answer array<string>, "
                                         "words array<string>").where(F.size("words") > 0), "benchmark-items")
    n, total = items.agg(F.count(F.lit(1)), F.sum(F.size("words"))).first()
    if not n:
        return
    n_shards = -(-total // shard_words)
    frequency = (items.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w")
                 .agg(F.count(F.lit(1)).alias("n")))
    frequency = stage(frequency, "benchmark-terms") if n_shards > 1 else frequency
    for s in range(n_shards):
        own = items.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(n_shards)) == s)
        rows = [tuple(r) for r in own.collect()]  # about ``shard_words`` words
        rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
        terms = frequency.join(own.select(F.explode("words").alias("w")).distinct(), "w", "left_semi") \
            if n_shards > 1 else frequency
        yield build_index(rows, {r["w"]: r["n"] for r in terms.collect()}, n, total / n)


def _searcher(spark, index: Index, retrieve: float, overlap: float) -> Callable:
    shared = spark.sparkContext.broadcast(index)
    return lambda texts: search(shared.value, texts, retrieve, overlap)


_BATCH = 64  # texts searched at once


def leaks(docs: DataFrame, benchmark: DataFrame, retrieve: float = RETRIEVE, overlap: float = OVERLAP) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, score, question_overlap, answer_overlap."""
    spark = docs.sparkSession
    texts = exactly(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    out = None
    for index in shards(benchmark):
        find = _searcher(spark, index, retrieve, overlap)

        def run(batches: Iterator[pa.RecordBatch], find=find) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, _BATCH):
                    part = batch.slice(i, _BATCH)
                    rows = [(d, *leak) for d, got in zip(part.column(0).to_pylist(), find(part.column(1).to_pylist()))
                            for leak in got]
                    if rows:
                        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                            names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"])

        rows = texts.mapInArrow(run, PAIRS)
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], PAIRS) if out is None else out


def decontaminate(docs: DataFrame, benchmark: DataFrame, retrieve: float = RETRIEVE,
                  overlap: float = OVERLAP) -> DataFrame:
    """The documents in which no item leaked, columns unchanged; each row is judged on its own text."""
    at = docs.columns.index("text")
    for index in shards(benchmark):
        find = _searcher(docs.sparkSession, index, retrieve, overlap)

        def run(batches: Iterator[pa.RecordBatch], find=find) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(0, batch.num_rows, _BATCH):
                    part = batch.slice(i, _BATCH)
                    yield part.filter(pa.array([not got for got in find(part.column(at).to_pylist())], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return leaks(docs, benchmark)
