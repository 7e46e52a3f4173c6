"""Token ids in binary files: patched frame-of-reference (PFOR) blocks.

Documents are range-partitioned by ``doc_id`` and sorted, tokenised in that
order and written as shard files of about ``SHARD_TOKENS`` ids; every task
writes its own shards straight to the shared folder (temporary name, then
rename, so a retried or duplicate task leaves the same file). Nothing but one
manifest row per shard is gathered.

File layout (little-endian):

    8 s   magic ``PFORTOK1``          u32 block size     u32 documents
    u64   ids                         u32 blocks         u32 reserved
    documents x (u8 null flag, i64 doc_id, u32 ids)
    (blocks + 1) x u64                block starts from the first block; the last is the end
    per block: u32 minimum, u32 values, u32 exceptions, u32 width,
               values packed at ``width`` bits after subtracting the minimum,
               exceptions x u32 position, exceptions x u32 value

``width`` is the number of bits that holds the ``percentile`` of a block's
differences; larger ones are exceptions, packed as 0 and patched on reading.

Defined results: a null text is empty (it still gets the end id); null doc_ids
come first; rows that share a doc_id follow each other in text order; an empty
table writes no file and gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from donorlens.llm.common import exactly, new_path, stage
from donorlens.llm.tokens import BATCH

MAGIC = b"PFORTOK1"
BLOCK = 4096
PERCENTILE = 90.0
SHARD_TOKENS = 4_000_000
_HEAD = struct.Struct("<8sIIQII")
_BLOCK_HEAD = struct.Struct("<IIII")
_DOC = np.dtype([("null", "u1"), ("doc_id", "<i8"), ("n", "<u4")])
MANIFEST = "part int, shard int, file string, n_docs long, n_tokens long, n_bytes long"


def pack_bits(values: np.ndarray, width: int) -> bytes:
    if not width:
        return b""
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little", count=width)
    return np.packbits(bits.reshape(-1), bitorder="little").tobytes()


def unpack_bits(raw: bytes, n: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(n, dtype=np.uint32)
    bit = np.arange(n, dtype=np.int64) * width
    windows = np.ndarray(len(raw), "<u8", raw + bytes(8), strides=(1,))  # the 8 bytes from every byte on
    values = windows[bit >> 3] >> (bit & 7).astype(np.uint64)
    return (values & np.uint64((1 << width) - 1)).astype(np.uint32)


def encode_block(ids: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    low = int(ids.min())
    diff = ids - np.uint32(low)
    at = min(len(diff) - 1, int(len(diff) * percentile / 100))
    width = int(np.partition(diff, at)[at]).bit_length()
    out = np.flatnonzero(diff >> np.uint32(width)) if width < 32 else np.zeros(0, dtype=np.int64)
    packed = diff.copy()
    packed[out] = 0
    return (_BLOCK_HEAD.pack(low, len(ids), len(out), width) + pack_bits(packed, width)
            + out.astype("<u4").tobytes() + ids[out].astype("<u4").tobytes())


def decode_block(raw: bytes) -> np.ndarray:
    low, n, n_out, width = _BLOCK_HEAD.unpack_from(raw)
    at = _BLOCK_HEAD.size
    size = (n * width + 7) // 8
    ids = unpack_bits(raw[at:at + size], n, width) + np.uint32(low)
    at += size
    where = np.frombuffer(raw, "<u4", n_out, at)
    ids[where] = np.frombuffer(raw, "<u4", n_out, at + 4 * n_out)
    return ids


def encode_file(doc_ids: list[int | None], docs: list[bytes], percentile: float = PERCENTILE,
                block: int = BLOCK) -> bytes:
    """One shard: ``docs`` are the documents' ids as little-endian unsigned 32-bit integers."""
    table = np.zeros(len(docs), dtype=_DOC)
    table["null"] = [d is None for d in doc_ids]
    table["doc_id"] = [0 if d is None else d for d in doc_ids]
    table["n"] = [len(d) // 4 for d in docs]
    ids = np.frombuffer(b"".join(docs), "<u4")
    blocks = [encode_block(ids[i:i + block], percentile) for i in range(0, len(ids), block)]
    starts = np.cumsum([0, *map(len, blocks)]).astype("<u8")
    return b"".join([_HEAD.pack(MAGIC, block, len(docs), len(ids), len(blocks), 0), table.tobytes(),
                     starts.tobytes(), *blocks])


def read_header(raw: bytes) -> tuple[int, np.ndarray, np.ndarray, int]:
    """(block size, document table, block starts, where the first block begins)"""
    magic, block, n_docs, n_ids, n_blocks, _ = _HEAD.unpack_from(raw)
    if magic != MAGIC:
        raise ValueError("not a PFOR token file")
    at = _HEAD.size
    table = np.frombuffer(raw, _DOC, n_docs, at)
    at += table.nbytes
    starts = np.frombuffer(raw, "<u8", n_blocks + 1, at).astype(np.int64)
    return block, table, starts, at + 8 * (n_blocks + 1)


def read_range(raw: bytes, start: int, n: int) -> np.ndarray:
    """Ids ``start`` to ``start + n`` of a shard; the index finds the blocks, no other is decoded."""
    block, _, starts, body = read_header(raw)
    if n <= 0:
        return np.zeros(0, dtype=np.uint32)
    first, last = start // block, (start + n - 1) // block
    ids = np.concatenate([decode_block(raw[body + starts[b]:body + starts[b + 1]]) for b in range(first, last + 1)])
    return ids[start - first * block:start - first * block + n]


def decode_file(raw: bytes) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, start in the shard, ids) of every document of a shard."""
    _, table, starts, body = read_header(raw)
    ids = [decode_block(raw[body + a:body + b]) for a, b in zip(starts[:-1], starts[1:])]
    flat = np.concatenate(ids) if ids else np.zeros(0, dtype=np.uint32)
    at = 0
    for null, doc_id, n in table.tolist():
        yield None if null else doc_id, at, flat[at:at + n]
        at += n


def _store(directory: str, name: str, raw: bytes) -> None:
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(directory)
    store.create_dir(base, recursive=True)
    draft = f"{base}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft) as out:
        out.write(raw)
    store.move(draft, f"{base}/{name}")


def write_token_files(docs: DataFrame, directory: str, make_encoder: Callable, end_id: int, *,
                      percentile: float = PERCENTILE, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shards; returns the manifest (one row per shard, staged).

    ``make_encoder()`` runs in the worker and gives ``encode(texts) -> [bytes]``.
    """
    end = np.uint32(end_id).astype("<u4").tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, shard = make_encoder(), TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        found: list[bytes] = []
        rows: list[tuple] = []
        size = 0

        def flush() -> None:
            nonlocal shard, size
            name = f"tokens-{part:06d}-{shard:06d}.pfor"
            raw = encode_file(ids, found, percentile)
            _store(directory, name, raw)
            rows.append((part, shard, name, len(ids), size // 4, len(raw)))
            ids.clear()
            found.clear()
            shard, size = shard + 1, 0

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i in range(0, len(texts), BATCH):
                for doc_id, raw in zip(doc_ids[i:i + BATCH], encode(texts[i:i + BATCH])):
                    ids.append(doc_id)
                    found.append(raw + end)
                    size += len(raw) + 4
                    if size >= 4 * shard_tokens:
                        flush()
        if ids:
            flush()
        cols = list(zip(*rows)) or [[]] * 6
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 3))],
            names=["part", "shard", "file", "n_docs", "n_tokens", "n_bytes"])

    ordered = (exactly(docs, "doc_id", "text")
               .select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
               .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text"))
    return stage(ordered.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(spark: SparkSession, directory: str, manifest: DataFrame, *,
                     with_ids: bool = False) -> DataFrame:
    """One row per document, decoded from the files: doc_id, start (ids of all documents before
    it), n_tokens, ids_crc32, file (and the ids, on request)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                docs = list(decode_file(raw.as_py()))
                file = path.rsplit("/", 1)[-1]
                arrays = [pa.array([d[0] for d in docs], pa.int64()), pa.array([d[1] for d in docs], pa.int64()),
                          pa.array([len(d[2]) for d in docs], pa.int64()),
                          pa.array([zlib.crc32(d[2].tobytes()) for d in docs], pa.int64()),
                          pa.array([file] * len(docs), pa.string())]
                names = ["doc_id", "_at", "n_tokens", "ids_crc32", "file"]
                if with_ids:
                    arrays.append(pa.array([d[2].astype(np.int64) for d in docs], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = "doc_id long, _at long, n_tokens long, ids_crc32 long, file string" + ", ids array<long>" * with_ids
    # The manifest has one row per shard of millions of ids: numbering it is one small task.
    before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.select("file", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("_base"))
    if manifest.isEmpty():
        return spark.createDataFrame([], schema.replace("_at", "start"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(directory).select("path", "content")
    rows = files.mapInArrow(read, schema).join(bases, "file")
    cols = ["doc_id", (F.col("_base") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32", "file"]
    return rows.select(*cols, *(["ids"] if with_ids else []))


def word_encoder(path: str) -> Callable:
    """An encoder factory for the lower-casing word vocabulary at ``path``."""

    def make():
        from donorlens.llm.tokens import word_tokenizer

        return word_tokenizer(path).encode

    return make


def query(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    spark = docs.sparkSession
    directory = new_path(spark, "token-files")
    manifest = write_token_files(docs, directory, word_encoder(vocabulary), end_id)
    return read_token_files(spark, directory, manifest)
