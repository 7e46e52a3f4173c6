"""Removal of long repeated passages by suffix arrays built in two stages.

A byte goes if it lies in a string of ``LENGTH`` bytes that also starts in a
document with a smaller doc_id (judged on the input, overlaps included).

1. One pass keys every window of ``LENGTH`` bytes by the least hash of its
   ``GRAM``-byte strings. Equal windows have equal keys, and neighbouring windows
   mostly share one, so a *run* of windows (at most ``RUN``) has one key. The runs
   themselves are not stored: tasks combine their keys and pass them on as 32-bit
   numbers in buckets, whose number follows the size of the texts; one that two
   documents or two tasks have is in its bucket twice. These mark the bits of a
   filter whose size follows their number, up to 2 ** ``FILTER_BITS`` bits.
2. A second pass finds the runs again and keeps those whose key passes the filter
   (a key that passes by chance, or by copies of a row under one doc_id, meets no
   other document), with a hash in place of their bytes. Per key the least and the greatest
   hash and document are combined map-side, so a passage in a third of all documents is
   one row per task. Where all runs of a key are equal there is nothing to sort:
   every document but the first loses them.
3. A third pass cuts the runs of the other keys from their texts. Equal ones
   collapse to one *snippet* with its smallest doc_id, again combined map-side.
   Snippets are dealt to blocks by key, and a task builds a suffix array per
   block of about ``BLOCK_BYTES``, of the suffixes that start a whole window: only those smaller
   than their successor are sorted directly, the others are induced by a scan over the buckets. Adjacent
   common prefixes of ``LENGTH`` bytes bound groups of equal strings; each group's
   smallest document decides. A key with more than ``HOT`` different snippets is
   first cut into single windows that are dealt by their own hash, so no key
   gathers an unbounded block.
4. Removed ranges are united per document, go back to it and are cut out of the texts. A second filter marks
   the documents that have any, so that the other texts are not shuffled.

Defined results: a null text is empty; texts under ``LENGTH`` bytes keep
everything; a row without a doc_id has no place in the order: nothing is removed
from it and it removes nothing; rows that share a doc_id do not remove each
other's bytes and each is judged on its own text (equal rows, whatever their number, share one list of ranges); extra columns
are ignored; texts are keyed end to end, ``CHUNK`` windows at a time.

A run meets its equals, and a snippet its verdict, on two 64-bit hashes of its bytes, which are
compared in full inside the suffix arrays only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, functions as F

from donorlens.llm.common import batches_of, by_rows, by_value, discard, exactly, stage

LENGTH = 50
GRAM = 20
RUN = 64
BLOCK_BYTES = 1 << 20
HOT = 20_000
FILTER_BITS = 30     # bits of the largest filter: 128 MB
CHUNK = 1 << 17      # windows keyed at once: bounds the memory of a very long text
TEXTS = 512          # texts keyed end to end
BATCH = 1_000        # texts that cross to Python at a time
CUT_BYTES = 1 << 20  # bytes of runs cut from their texts at once
RANGES = 1 << 16     # runs whose ranges are united at once
HELD = 1_000_000     # keys a task holds before it passes them on
BUCKET_BYTES = 1 << 25  # bytes of text whose keys make a bucket


# -- windows and their keys -------------------------------------------------------

def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes at every place as one big-endian number; zeros follow the end."""
    padded = np.r_[data, np.zeros(16, dtype=np.uint8)]
    out = np.empty(len(data) + 8, dtype=np.uint64)
    for k in range(8):
        part = out[k::8]
        part[:] = padded[k:k + 8 * len(part)].view(">u8")
    return out[:len(data)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _fold(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Takes eight more bytes into ``h``, in place."""
    h ^= words
    h ^= h >> np.uint64(32)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h


def window_keys(data: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> np.ndarray:
    """One key per window of ``length`` bytes (``gram`` <= ``length``, ``gram`` >= 8)."""
    n = len(data) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    words, grams = _words(data), len(data) - gram + 1
    h = np.zeros(grams, dtype=np.uint64)
    for at in [*range(0, gram - 8, 8), gram - 8]:
        _fold(h, words[at:at + grams])
    h ^= h >> np.uint64(29)
    width, span = length - gram + 1, 1
    while 2 * span <= width:  # least of 2, 4, 8, ... neighbours
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    return np.minimum(h[:n], h[width - span:width - span + n])


def window_runs(data: np.ndarray, bounds: np.ndarray, length: int = LENGTH, gram: int = GRAM,
                run: int = RUN) -> tuple[np.ndarray, ...]:
    """(text, key, start, number of windows) of the runs of neighbouring windows with one key. The texts
    lie end to end in ``data``, text i from ``bounds[i]`` to ``bounds[i + 1]``; starts are places in ``data``."""
    out = []
    for base in range(0, max(0, len(data) - length + 1), CHUNK):
        found = window_keys(data[base:base + CHUNK + length - 1], length, gram)
        edge = np.r_[True, found[1:] != found[:-1]]
        edge[bounds[np.searchsorted(bounds, base):np.searchsorted(bounds, base + len(found))] - base] = True
        at = np.flatnonzero(edge)
        size = np.diff(np.r_[at, len(found)])
        parts = -(-size // run)  # windows of one long repetition: more than one run
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        start, end = np.repeat(at, parts) + run * nth, np.repeat(at + size, parts)
        key = found[start]
        owner = np.searchsorted(bounds, start + base, "right") - 1
        # windows that reach into the next text are none
        n = np.minimum(np.minimum(start + run, end), bounds[owner + 1] - length + 1 - base) - start
        whole = n > 0
        out.append((owner[whole], key[whole], start[whole] + base, n[whole]))
    if not out:
        return tuple(np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*out))


def _end_to_end(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ``texts`` (no nulls) and the bounds of each."""
    texts = texts.cast(pa.large_binary())
    _, bounds, data = texts.buffers()
    bounds = np.frombuffer(bounds, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


# -- the suffix array of a block ----------------------------------------------------

def _sort_directly(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes ``at`` in the order of at least their first ``depth`` bytes; only ties are looked at again,
    their group above as many more bytes as one number holds."""
    order = at[np.argsort(words[at])]
    new = np.ones(len(order), dtype=bool)
    new[1:] = words[order[1:]] != words[order[:-1]]
    done = 8
    while done < depth:
        tied = np.flatnonzero(~(new & np.r_[new[1:], True]))
        if not len(tied):
            break
        own, group = order[tied], np.cumsum(new[tied]).astype(np.uint64)
        more = (64 - int(group[-1]).bit_length()) // 8
        key = (group << np.uint64(8 * more)) | (words[own + done] >> np.uint64(64 - 8 * more))
        by = np.argsort(key)
        order[tied], key = own[by], key[by]
        new[tied] = np.r_[True, key[1:] != key[:-1]]
        done += more
    return order


def suffix_array(text: np.ndarray, depth: int = LENGTH, wanted: np.ndarray | None = None) -> np.ndarray:
    """Suffix places in the order of at least ``depth`` bytes, by two-stage sorting.

    With ``wanted`` (a boolean per place) only these places are in it, and those they are induced from.

    A suffix is *small* if it is smaller than its successor. Small suffixes are sorted directly;
    scanning the buckets (by first byte) upwards, each finished suffix puts its predecessor, if
    that is not small, behind the others of its bucket.
    """
    n = len(text)
    if not n:
        return np.zeros(0, dtype=np.int64)
    after = np.r_[text[1:], np.uint8(0)].astype(np.int16)
    sign = np.sign(after - text)
    sign[-1] = -1  # the end is smaller than anything
    decided = np.where(sign != 0, np.arange(n), n - 1)
    small = sign[np.minimum.accumulate(decided[::-1])[::-1]] > 0  # equal bytes: as the next place that differs
    if wanted is None:
        large = ~small
    else:
        # a place that is not small needs its successor, up to the next small one
        at = np.arange(n)
        asked = np.maximum.accumulate(np.where(wanted, at, -1))
        ended = np.maximum.accumulate(np.where(small, at, -1))
        needed = asked > np.r_[-1, ended[:-1]]
        small, large = small & needed, ~small & needed
    words = np.r_[_words(text), np.zeros(depth, dtype=np.uint64)]
    direct = _sort_directly(np.flatnonzero(small), words, depth)
    firsts = text[direct]
    bounds = np.searchsorted(firsts, np.arange(257))
    queued: list[list[np.ndarray]] = [[] for _ in range(256)]
    if large[-1]:
        queued[text[-1]].append(np.array([n - 1]))  # preceded by the empty suffix
    out: list[np.ndarray] = []

    def queue_predecessors(done: np.ndarray, own: int) -> None:
        before = done[done > 0] - 1
        before = before[large[before] & (text[before] != own)]
        before = before[np.argsort(text[before], kind="stable")]
        byte = text[before]
        edges = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]]) if len(byte) else []
        for a, b in zip(edges, [*edges[1:], len(byte)]):
            queued[byte[a]].append(before[a:b])

    for b in range(256):
        now = np.concatenate(queued[b]) if queued[b] else direct[:0]
        larger = []
        while len(now):  # a run of equal bytes is induced byte by byte
            larger.append(now)
            now = _own(now, b, text, large)
        bucket = np.concatenate([*larger, direct[bounds[b]:bounds[b + 1]]])
        if len(bucket):
            out.append(bucket)
            queue_predecessors(bucket, b)
    return np.concatenate(out) if out else direct


def _own(done: np.ndarray, byte: int, text: np.ndarray, large: np.ndarray) -> np.ndarray:
    before = done[done > 0] - 1
    return before[(text[before] == byte) & large[before]]


def equal_to_next(text: np.ndarray, order: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each suffix in ``order`` but the last: is its common prefix with the next ``length`` bytes long?"""
    words = np.r_[_words(text), np.zeros(length, dtype=np.uint64)]
    at = np.arange(max(0, len(order) - 1))
    for k in [*range(0, length - 8, 8), length - 8]:
        at = at[words[order[at] + k] == words[order[at + 1] + k]]
    same = np.zeros(max(0, len(order) - 1), dtype=bool)
    same[at] = True
    return same


def earlier_windows(snippets: pa.Array, docs: np.ndarray, length: int = LENGTH) -> pa.Array:
    """Per snippet (binary, of ``length`` bytes at least) a bit for each of its windows: does it also stand in a
    snippet of a smaller document? No bytes where none does."""
    data, bounds = _end_to_end(snippets)
    nth, sizes = np.arange(len(docs)), np.diff(bounds)
    # UTF-8 has no byte above 0xF4: bytes move up by one and 0 ends a snippet
    text = np.insert(data + np.uint8(1), bounds[1:], np.uint8(0))
    starts, n = bounds[:-1] + nth, sizes - length + 1
    owner = np.repeat(nth, sizes + 1)
    windows = np.zeros(len(text), dtype=bool)
    at = np.arange(n.sum()) + np.repeat(starts - np.cumsum(n) + n, n)
    windows[at] = True
    order = suffix_array(text, length, windows)
    order = order[windows[order]]
    group = np.flatnonzero(np.r_[np.ones(min(1, len(order)), bool), ~equal_to_next(text, order, length)])
    doc = docs[owner[order]]
    least = np.repeat(np.minimum.reduceat(doc, group), np.diff(np.r_[group, len(order)])) if len(order) else doc
    flags = np.zeros(len(text), dtype=bool)
    flags[order] = least < doc
    seen = at[flags[at]]
    size = (n + 7) // 8 * (np.bincount(owner[seen], minlength=len(docs)) > 0)
    ends = np.cumsum(size)
    bits = np.zeros(8 * size.sum(), dtype=bool)
    bits[seen + (8 * (ends - size) - starts)[owner[seen]]] = True
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(docs), [
        None, pa.py_buffer(np.r_[0, ends].astype(np.int64)), pa.py_buffer(np.packbits(bits))]).cast(pa.binary())


# -- Spark stages -------------------------------------------------------------------

_TEXTS = ["CAST(doc_id AS BIGINT) AS doc_id", "coalesce(text, '') AS text",
          "shiftleft(CAST(hash(text) AS BIGINT), 32) AS tag"]  # tells rows apart that share a doc_id


def _long(texts: DataFrame) -> DataFrame:
    return texts.where(f"doc_id IS NOT NULL AND octet_length(text) >= {LENGTH}")


def _bucket_bits(texts: DataFrame) -> int:
    """Bits of the number of buckets for the keys of ``texts``."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return min(31, max(6, (int(size) // BUCKET_BYTES).bit_length()))


def _places(keys: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` bits of a key's bucket above 32 bits of its place there; mixed first, because least hashes
    crowd near 0."""
    return (_mix(keys) >> np.uint64(32 - bits)).astype(np.int64)


def _keys(texts: DataFrame, bits: int) -> DataFrame:
    """(bucket, places): the distinct window keys of a task's texts, those of several documents twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                part = batch.slice(i, TEXTS)
                owner, keys, _, _ = window_runs(*_end_to_end(part.column(1)))
                held.append((_places(keys, bits), part.column(0).to_numpy()[owner]))
                size += len(keys)
                if size > HELD:
                    yield pack(held)
                    held, size = [], 0
        if size:
            yield pack(held)

    def pack(held):
        place, doc = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(place)
        place, doc = place[order], doc[order]
        at = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        several = np.minimum.reduceat(doc, at) < np.maximum.reduceat(doc, at)
        place = np.repeat(place[at], 1 + several)
        bucket = place >> 32
        first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        places = pa.array(place.astype(np.uint32).view(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[first]), pa.ListArray.from_arrays(pa.array(np.r_[first, len(place)], pa.int32()), places)],
            names=["bucket", "places"])

    return _long(texts).select("doc_id", "text").mapInArrow(run, "bucket long, places array<int>")


def _shared_keys(texts: DataFrame, bits: int) -> DataFrame:
    """(m): the places of the keys that two documents have (or two tasks, for rows of one doc_id)."""

    def shared(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        place = np.sort(np.concatenate(pdf["places"].to_list()).astype(np.int32).view(np.uint32))
        twice = np.unique(place[1:][place[1:] == place[:-1]])
        return pd.DataFrame({"m": twice.astype(np.int64) | (int(key[0]) << 32)})

    return _keys(texts, bits).groupBy("bucket").applyInPandas(shared, "m long")


def _slots(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Places in a filter; mixed first, because least hashes crowd near 0."""
    return (_mix(hashes) >> np.uint64(64 - bits)).astype(np.int64)


class Filter:
    """A bit per slot of a hash: no false negatives. Built in segments over Spark; ``bits`` follows the
    number of entries, so a sparse one is small and the largest is 2 ** ``FILTER_BITS`` bits."""

    SEGMENT = 20  # bits of a slot's place in its segment

    def __init__(self, hashes: DataFrame):
        """``hashes``: one column of longs, staged (it is read twice)."""
        n = hashes.count()
        self.bits = bits = min(FILTER_BITS, max(self.SEGMENT, int(16 * n).bit_length()))
        width = self.SEGMENT

        def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                slot = _slots(batch.column(0).to_numpy().view(np.uint64), bits)
                yield pa.RecordBatch.from_arrays([pa.array(slot >> width), pa.array(slot & ((1 << width) - 1))],
                                                 names=["segment", "at"])

        def segment(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            marks = np.zeros(1 << width, bool)
            marks[pdf["at"].to_numpy()] = True
            return pd.DataFrame({"segment": [key[0]], "marks": [np.packbits(marks).tobytes()]})

        marked = hashes.mapInArrow(slots, "segment long, at long").distinct().groupBy("segment")
        table = bytearray(1 << (bits - 3))
        size = 1 << (width - 3)
        for r in marked.applyInPandas(segment, "segment long, marks binary").collect():  # the filter's own size
            table[r["segment"] * size:(r["segment"] + 1) * size] = r["marks"]
        self.table = hashes.sparkSession.sparkContext.broadcast(bytes(table))

    def probe(self):
        """For tasks: hashes (uint64) to booleans."""
        table, bits = self.table, self.bits

        def hit(hashes: np.ndarray) -> np.ndarray:
            slots = _slots(hashes, bits)
            marks = np.frombuffer(table.value, np.uint8)
            return (marks[slots >> 3] >> (7 - (slots & 7)).astype(np.uint8)) & 1 > 0

        return hit


def _snippets(texts: DataFrame, wanted) -> DataFrame:
    """(m, doc, place, n, s): the runs whose keys are ``wanted`` (uint64 to booleans), with their bytes.
    ``place`` holds the row's tag above and the start below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, TEXTS):
                part = batch.slice(i, TEXTS)
                data, bounds = _end_to_end(part.column(1))
                runs = window_runs(data, bounds)
                kept = wanted(runs[1])
                runs = [c[kept] for c in runs]
                before = np.cumsum(runs[3] + LENGTH - 1) // CUT_BYTES
                for at in np.split(np.arange(len(before)), np.flatnonzero(np.diff(before)) + 1):
                    yield cut(part, data, bounds, *(c[at] for c in runs))

    def cut(part, data, bounds, owner, keys, start, n):
        size = n + LENGTH - 1
        ends = np.cumsum(size)
        found = data[np.arange(size.sum()) + np.repeat(start - ends + size, size)]
        s = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [
            None, pa.py_buffer(np.r_[0, ends].astype(np.int64)), pa.py_buffer(found)]).cast(pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(part.column(0).to_numpy()[owner]),
             pa.array(part.column(2).to_numpy()[owner] | (start - bounds[owner])), pa.array(n.astype(np.int32)), s],
            names=["m", "doc", "place", "n", "s"])

    return _long(texts).select("doc_id", "text", "tag").mapInArrow(run, "m long, doc long, place long, n int, s binary")


def _single_windows(snippets: DataFrame, hot: DataFrame) -> DataFrame:
    """Snippets of hot keys, each window on its own and keyed by its own hash."""
    windows = snippets.join(hot.select("m"), "m", "left_semi").selectExpr(
        "doc", f"explode(transform(sequence(0, n - 1), i -> struct(place + i AS place, substring(s, i + 1, {LENGTH}) AS s))) AS w")
    return windows.selectExpr("xxhash64(w.s) AS m", "doc", "w.place AS place", "1 AS n", "w.s AS s")


def _judge(classes: DataFrame) -> DataFrame:
    """(m, c, first, seen): per snippet class its smallest document and a bit per window, set if a
    smaller document has that window (no bytes where none is set). One suffix array per block."""
    size = classes.agg(F.coalesce(F.sum(F.octet_length("s") + 1), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // BLOCK_BYTES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in by_value(batches, 0):
            _, m, c, first, s = (x.combine_chunks() for x in block.columns)
            yield pa.RecordBatch.from_arrays([m, c, first, earlier_windows(s, first.to_numpy())],
                                             names=["m", "c", "first", "seen"])

    dealt = (classes.withColumn("block", F.pmod(F.xxhash64("m"), F.lit(blocks)))
             .repartition("block").sortWithinPartitions("block"))
    return dealt.select("block", "m", "c", "first", "s").mapInArrow(run, "m long, c long, first long, seen binary")


def removed_ranges(texts: DataFrame) -> DataFrame:
    """(doc_id, tag, starts, ends): per document with removals its removed ranges, in order and apart.
    Staged; what was staged on the way goes as soon as it is used."""
    bits = _bucket_bits(texts)
    shared = stage(_shared_keys(texts, bits), "shared-keys")
    hit = Filter(shared).probe()
    discard(shared)
    runs = _snippets(texts, lambda keys: hit(_places(keys, bits).view(np.uint64)))
    # a wide dictionary: few bytes for what the runs of a document have in common
    wide = {"parquet.dictionary.page.size": 16 << 20, "parquet.block.size": 32 << 20}
    runs = stage(runs.selectExpr("m", "xxhash64(s) AS c", "doc", "place", "n"), "shared-runs", **wide)
    keys = stage(runs.groupBy("m").agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.min("c").alias("c"),
                                       F.max("c").alias("other")).where("first < last").drop("last"), "keys-of-several")
    mixed = Filter(stage(keys.where("c <> other").select("m"), "mixed-keys")).probe()
    snippets = _snippets(texts, mixed).withColumn("c", F.xxhash64("s"))
    classes = told = stage(snippets.groupBy("m", "c", "s").agg(F.min("doc").alias("first")), "snippet-classes")
    hot = stage(classes.groupBy("m").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > HOT), "hot-keys")
    places = runs
    if not hot.isEmpty():
        single = stage(_single_windows(snippets, hot).withColumn("c", F.xxhash64("s", F.lit(1))), "single-windows")
        more = single.groupBy("m", "c", "s").agg(F.min("doc").alias("first"))
        classes = classes.join(hot.select("m"), "m", "left_anti").unionByName(more)
        places = (places.join(hot.select("m"), "m", "left_anti")
                  .unionByName(single.select("m", "c", "doc", "place", "n")))
    # a key of equal runs has no windows that a smaller document has, but its copies' own
    alike = keys.where("c = other").selectExpr("m", "c", "first", "CAST(NULL AS BINARY) AS seen")
    judged = stage(_judge(classes), "judged-snippets")
    discard(told)
    gone = places.join(judged.unionByName(alike), ["m", "c"]).where("doc > first OR octet_length(seen) > 0")
    gone = gone.selectExpr("doc AS doc_id", "shiftleft(shiftright(place, 32), 32) AS tag",
                           "place & 4294967295 AS start", "n", "CASE WHEN doc = first THEN seen END AS seen")
    ranges = stage(_united(gone), "removed-ranges")
    discard(runs, keys, judged)
    return ranges


def _spans(start: np.ndarray, n: np.ndarray, seen: pa.Array) -> tuple[np.ndarray, ...]:
    """(row, start, end) of the ranges that the runs in the rows remove: of all windows of a run, or of those
    marked in ``seen``."""
    marked = np.asarray(seen.is_valid())
    whole, part = np.flatnonzero(~marked), np.flatnonzero(marked)
    raw, bounds = _end_to_end(seen.fill_null(b""))
    n_of = n[part]
    row = np.repeat(part, n_of)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n_of) - n_of, n_of)
    hit = np.unpackbits(raw)[8 * bounds[row] + at] > 0
    row, at = row[hit], start[row[hit]] + at[hit]
    return np.r_[whole, row], np.r_[start[whole], at], np.r_[start[whole] + n[whole] - 1, at] + LENGTH


def _united(gone: DataFrame) -> DataFrame:
    """(doc_id, tag, starts, ends): the ranges of a document's runs (doc_id, tag, start, n, seen), united where
    they meet; equal rows of a document have equal ranges. A null ``seen`` stands for all windows of the run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 4  # the ranges of the last document so far
        for rows in by_rows(batches, RANGES):
            doc, tag, start, n, seen = (c.combine_chunks() for c in rows.columns)
            row, start, end = _spans(start.to_numpy(), n.to_numpy(), seen)
            found = unite(*(np.r_[h, c] for h, c in zip(held, (doc.to_numpy()[row], tag.to_numpy()[row], start, end))))
            last = np.searchsorted(found[0], found[0][-1])
            yield pack(*(c[:last] for c in found[1:]))
            held = [c[last:] for c in found[1:]]
        if len(held[0]):
            yield pack(*held)

    def unite(doc, tag, start, end):
        by = np.lexsort((start, tag, doc))
        doc, tag, start, end = doc[by], tag[by], start[by], end[by]
        other = np.r_[False, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])]
        name = np.cumsum(other)
        reach = np.maximum.accumulate((name << 32) + end)
        first = np.flatnonzero(np.r_[True, (name << 32)[1:] + start[1:] > reach[:-1]])
        ends = reach[np.r_[first[1:], len(reach)] - 1] - (name[first] << 32)
        return name[first], doc[first], tag[first], start[first], ends

    def pack(doc, tag, start, end):
        first = np.flatnonzero(np.r_[np.ones(min(1, len(doc)), bool), (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])
        bounds = pa.array(np.r_[first, len(doc)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(doc[first]), pa.array(tag[first]), *(
                pa.ListArray.from_arrays(bounds, pa.array(c.astype(np.int32))) for c in (start, end))],
            names=["doc_id", "tag", "starts", "ends"])

    dealt = gone.repartition("doc_id", "tag").sortWithinPartitions("doc_id", "tag")
    return dealt.mapInArrow(run, "doc_id long, tag long, starts array<int>, ends array<int>")


def cut_out(texts: pa.Array, starts: pa.ListArray, ends: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """What is left of each text without its ranges (in order and apart), its bytes and its number of ranges."""
    data, bounds = _end_to_end(texts)
    n = np.asarray(pa.compute.list_value_length(starts).fill_null(0)).astype(np.int64)
    a, b = (c.flatten().to_numpy().astype(np.int64) for c in (starts, ends))
    owner = np.repeat(np.arange(len(n)), n)
    # removed ranges of neighbouring texts may meet: no place has two starts or two ends
    steps = np.zeros(len(data) + 1, dtype=np.int8)
    steps[a + bounds[owner]] += 1
    steps[b + bounds[owner]] -= 1
    kept = data[np.cumsum(steps[:-1], dtype=np.int8) == 0]
    sizes = np.diff(bounds)
    left = sizes - np.diff(np.r_[0, np.cumsum(b - a)][np.r_[0, np.cumsum(n)]])
    whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [
        None, pa.py_buffer(np.r_[0, np.cumsum(left)].astype(np.int64)), pa.py_buffer(kept)])
    return whole.cast(pa.binary()), sizes, n


def deduplicate(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_spans, kept (binary: the remaining bytes)."""
    texts = exactly(docs, "doc_id", "text").selectExpr(*_TEXTS)

    names = ["doc_id", "n_bytes", "n_spans", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                doc, *cut = batch.slice(i, 256).columns
                kept, size, n = cut_out(*cut)
                yield pa.RecordBatch.from_arrays([doc, pa.array(size), pa.array(n), kept], names=names)

    schema = "doc_id long, n_bytes long, n_spans long, kept binary"
    with batches_of(docs.sparkSession, BATCH):
        ranges = removed_ranges(texts)
    name = F.xxhash64("doc_id", "tag")
    touched = Filter(stage(ranges.select(name.alias("h")), "touched-documents")).probe()

    def pick(batches: Iterator[pa.RecordBatch], wanted: bool) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = touched(batch.column(3).to_numpy().view(np.uint64))
            yield batch.filter(pa.array(hit if wanted else ~hit))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pick(batches, False):
            kept = batch.column(1).cast(pa.binary())
            size = pa.compute.binary_length(kept).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(np.zeros(len(kept), np.int64)), kept], names=names)

    marked = texts.withColumn("h", name)
    changed = marked.mapInArrow(lambda b: pick(b, True), marked.schema)
    joined = changed.join(ranges, ["doc_id", "tag"], "left").select("doc_id", "text", "starts", "ends")
    return marked.mapInArrow(whole, schema).unionByName(joined.mapInArrow(run, schema))


def query(docs: DataFrame) -> DataFrame:
    digests = deduplicate(docs).select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                                       "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    with batches_of(docs.sparkSession, BATCH):
        return stage(digests, "suffix-digests")
