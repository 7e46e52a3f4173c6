"""SimHash near-duplicates by a binary-trie self-join.

1. One pass over the texts gives a 64-bit fingerprint per document; equal
   fingerprints collapse first, so a group of copies of any size is one row.
2. Self-join of the distinct fingerprints. At most ``k`` differing bits leave at
   least one of k + 1 bit blocks equal, so k + 1 tries are built, each with
   another block rotated to the front, and each is traversed by node pairs from
   the nodes below that block (no error allowed inside it): a pair's differing
   bits accumulate level by level and a pair over the budget is dropped with its
   whole subtree. Tasks get whole nodes of up to ``NODE_MAX`` fingerprints; a
   larger node is first split over Spark into its child-node pairs, pruned by
   the same budget, as deep as needed.
3. A task returns a spanning forest of the links it found (never the pairs of a
   group), and the forests are joined to components over Spark.

Defined results: a text without words (null, empty) has fingerprint 0 and links
like any other; rows that share a doc_id each get their row; null doc_ids are
ignored when the smallest id of a component is taken; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from donorlens.llm.common import exactly, stage
from donorlens.llm.components import components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
NODE_MAX = 16_384    # fingerprints of a trie node that one task takes whole
STEP = 4             # trie levels descended at once
FRONTIER = 2_000_000  # node pairs held at once in a task
BATCH_PAIRS = 4_000_000


# -- fingerprints ---------------------------------------------------------------

def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of one text; words are lower-cased in A-Z only."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-shingle].tolist()]
    digest = xxhash.xxh64_digest
    raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())])
    n = len(starts)
    ones = np.zeros(64, dtype=np.int64)
    hashes = np.frombuffer(raw, np.uint8).reshape(n, 8)
    for i in range(0, n, 4096):
        ones += np.unpackbits(hashes[i:i + 4096], axis=1).sum(axis=0, dtype=np.uint16)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, tagged: bool = False) -> DataFrame:
    """(doc_id, fp): fp holds the unsigned fingerprint's bits as a long. Staged. ``tagged`` adds a hash of
    the text (tag), which tells rows apart that share a doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]],
                                             names=["doc_id", "fp", *batch.schema.names[2:]])

    tag = [F.xxhash64("text").alias("tag")] * tagged
    texts = exactly(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text", *tag)
    return stage(texts.mapInArrow(run, "doc_id long, fp long" + ", tag long" * tagged), "fingerprints")


# -- the trie self-join inside a task -------------------------------------------

def _forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Component label (smallest index) of 0..n-1 under the links that ``pairs`` yields in blocks."""
    label = np.arange(n)
    for i, j in pairs:
        while True:
            a, b = label[i], label[j]
            apart = a != b
            if not apart.any():
                break
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def trie_links(tree: np.ndarray, values: np.ndarray, roots: np.ndarray, budget: int,
               frontier: int = FRONTIER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of linked index pairs (i, j) under node-pair traversal.

    ``values`` (uint64) are sorted and distinct inside each tree and ``tree`` ascends;
    ``roots`` holds rows (tree, tree, start depth): the root pairs to traverse.
    """
    depths = [*range(STEP, 64, STEP), 64]
    ids, firsts, kids = [], [], []  # per depth: node of each value, first value and children of each node
    change = np.r_[True, tree[1:] != tree[:-1]]
    above = np.cumsum(change) - 1
    first_of_tree = np.flatnonzero(change)
    up = first_of_tree
    for d in depths:
        head = values >> np.uint64(64 - d)
        new = change | np.r_[True, head[1:] != head[:-1]]
        first = np.flatnonzero(new)
        kids.append(np.r_[np.searchsorted(first, up), len(first)])
        firsts.append(first)
        up = first
    node_of = {int(t): k for k, t in enumerate(tree[first_of_tree])}
    a = np.array([node_of[int(t)] for t in roots[:, 0]], dtype=np.int64)
    b = np.array([node_of[int(t)] for t in roots[:, 1]], dtype=np.int64)
    stack = [(0, a, b, np.zeros(len(a), dtype=np.int64))]
    while stack:
        level, a, b, diff = stack.pop()
        if level == len(depths):
            apart = a != b
            if apart.any():
                yield a[apart], b[apart]
            continue
        start = kids[level]
        na, nb = start[a + 1] - start[a], start[b + 1] - start[b]
        grow = na * nb
        if len(a) > 1 and grow.sum() > frontier:
            cut = max(1, min(len(a) - 1, int(np.searchsorted(np.cumsum(grow), frontier))))
            stack.append((level, a[cut:], b[cut:], diff[cut:]))
            a, b, diff, na, nb, grow = a[:cut], b[:cut], diff[:cut], na[:cut], nb[:cut], grow[:cut]
        at = np.arange(grow.sum()) - np.repeat(np.cumsum(grow) - grow, grow)
        wide = np.repeat(nb, grow)
        ca = np.repeat(start[a], grow) + at // wide
        cb = np.repeat(start[b], grow) + at % wide
        both = np.repeat(diff, grow)
        inside = (np.repeat(a, grow) != np.repeat(b, grow)) | (ca <= cb)  # each pair of one node once
        shift = np.uint64(64 - depths[level])
        low = np.uint64((1 << STEP) - 1)
        bits = ((values[firsts[level][ca]] >> shift) ^ (values[firsts[level][cb]] >> shift)) & low
        both = both + np.bitwise_count(bits)
        keep = inside & (both <= budget)
        stack.append((level + 1, ca[keep], cb[keep], both[keep]))


def _task_links(task: np.ndarray, side: np.ndarray, values: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning-forest edges (value, value) of the node pairs in one batch. A task whose rows are
    all on side 0 is a node with itself."""
    order = np.lexsort((values, side, task))
    task, side, values = task[order], side[order], values[order]
    _, t = np.unique(task, return_inverse=True)
    tree = 2 * t + side
    crossed = np.zeros(t.max() + 1, dtype=bool)
    crossed[t[side == 1]] = True
    k = np.arange(len(crossed))
    roots = np.stack([2 * k, 2 * k + crossed], axis=1)
    label = _forest(len(values), trie_links(tree, values, roots, budget))
    linked = np.flatnonzero(label != np.arange(len(label)))
    return values[linked], values[label[linked]]


# -- over Spark -------------------------------------------------------------------

def _blocks(budget: int) -> list[tuple[int, int]]:
    """(first bit, width) of the budget + 1 blocks."""
    n = budget + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _rotated(fps: DataFrame, budget: int) -> DataFrame:
    """(rot, value, node): every fingerprint once per block, that block in front."""
    turns = F.array(*[F.struct(F.lit(i).alias("rot"), F.lit(a).alias("first"), F.lit(64 - w).alias("below"))
                      for i, (a, w) in enumerate(_blocks(budget))])
    return fps.select("fp", F.explode(turns).alias("t")).selectExpr(
        "t.rot AS rot", "shiftleft(fp, t.first) | shiftrightunsigned(fp, 64 - t.first) AS value", "t.below AS below"
    ).selectExpr("rot", "value", "shiftrightunsigned(value, below) AS node", "64 - below AS depth")


def _subproblems(rotated: DataFrame, budget: int, node_max: int) -> DataFrame:
    """(task, side, rot, value): the rows of every node pair that one task traverses."""
    sizes = stage(rotated.groupBy("rot", "depth", "node").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "trie-nodes")
    # first-level nodes are bounded by the block width: (budget + 1) x 2^13 rows at four bits
    whole = (rotated.join(sizes.where(F.col("n") <= node_max).select("rot", "node"), ["rot", "node"])
             .select(F.xxhash64("rot", "depth", "node", "node").alias("task"), F.lit(0).alias("side"), "rot", "value"))
    out = [whole]
    large = sizes.where(F.col("n") > node_max)
    if not large.isEmpty():
        members = stage(rotated.join(large.select("rot", "node"), ["rot", "node"]), "trie-members")
        pairs = large.select("rot", "depth", F.col("node").alias("a"), F.col("node").alias("b"),
                             F.lit(0).cast("long").alias("diff"))
        while not pairs.isEmpty():
            step = F.least(F.lit(STEP), 64 - F.col("depth"))
            below = members.select("rot", (F.col("depth") + step).alias("depth"), "value", F.col("node").alias("above"))
            members = stage(below.withColumn("node", F.expr("shiftrightunsigned(value, 64 - depth)")), "trie-members")
            kids = members.groupBy("rot", "depth", "above", "node").agg(F.count(F.lit(1)).alias("n"))
            ka = kids.select("rot", F.col("above").alias("a"), F.col("node").alias("ca"), F.col("n").alias("n_a"), "depth")
            kb = kids.select("rot", F.col("above").alias("b"), F.col("node").alias("cb"), F.col("n").alias("n_b"))
            grown = (pairs.drop("depth").join(ka, ["rot", "a"]).join(kb, ["rot", "b"])
                     .where("a != b OR ca <= cb")
                     .withColumn("diff", F.expr("diff + bit_count((ca ^ cb) & 15)")).where(F.col("diff") <= budget)
                     .select("rot", "depth", F.col("ca").alias("a"), F.col("cb").alias("b"), "diff", "n_a", "n_b"))
            grown = stage(grown, "trie-pairs")
            fit = grown.where((F.col("n_a") <= node_max) & (F.col("n_b") <= node_max) & ((F.col("a") != F.col("b")) | (F.col("n_a") > 1)))
            task = F.xxhash64("rot", "depth", "a", "b").alias("task")
            sides = fit.select(task, "rot", F.explode(F.expr(
                "CASE WHEN a = b THEN array(struct(0 AS side, a AS node)) "
                "ELSE array(struct(0 AS side, a AS node), struct(1 AS side, b AS node)) END")).alias("s"))
            out.append(sides.select("task", "rot", "s.side", "s.node").join(members.select("rot", "node", "value"), ["rot", "node"])
                       .select("task", "side", "rot", "value"))
            pairs = grown.where((F.col("n_a") > node_max) | (F.col("n_b") > node_max)).drop("n_a", "n_b")
    first, *rest = out
    for more in rest:
        first = first.unionByName(more)
    return first


def links(fps: DataFrame, budget: int = MAX_BITS, node_max: int = NODE_MAX) -> DataFrame:
    """Edges (u, v) over the distinct fingerprints ``fps`` (fp): a spanning forest per trie node
    pair, so the components equal those of all pairs within ``budget`` bits."""
    turns = [a for a, _ in _blocks(budget)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        pairs = 0.0

        def solve(rows):
            task, side, rot, value = (np.concatenate(c) for c in zip(*rows))
            u, v = [], []
            for r in np.unique(rot):
                own = rot == r
                x, y = _task_links(task[own], side[own], value[own], budget)
                back = np.uint64(turns[r])
                for got, to in ((x, u), (y, v)):
                    to.append(got if not turns[r] else (got >> back) | (got << (np.uint64(64) - back)))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in (u, v)], names=["u", "v"])

        for batch in batches:  # sorted by task: a task's rows are together
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            cols[3] = cols[3].view(np.uint64)
            edges = np.flatnonzero(np.r_[True, cols[0][1:] != cols[0][:-1]])
            for a, b in zip(edges, [*edges[1:], len(cols[0])]):
                part = tuple(c[a:b] for c in cols)
                same = held and held[-1][0][0] == part[0][0]
                if not same and pairs > BATCH_PAIRS:
                    yield solve(held)
                    held, pairs = [], 0.0
                held.append(part)
                pairs += float(b - a) ** 2 + 20 * (b - a)
        if held:
            yield solve(held)

    rows = _subproblems(_rotated(fps, budget), budget, node_max)
    dealt = rows.repartition("task").sortWithinPartitions("task")
    return dealt.select("task", F.col("side").cast("long"), F.col("rot").cast("long"), "value").mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    node_max: int = NODE_MAX) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable by links)."""
    rows, named = _components(docs, shingle, max_bits, node_max)
    return rows.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _components(docs: DataFrame, shingle: int, max_bits: int, node_max: int = NODE_MAX,
                tagged: bool = False) -> tuple[DataFrame, DataFrame]:
    """``fingerprints``, and (fp, label, component_id) of the distinct ones: the component and its smallest doc_id."""
    rows = fingerprints(docs, shingle, tagged)
    classes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("root")), "fingerprint-classes")
    label = components(links(classes.select("fp"), max_bits, node_max))
    joined = stage(classes.join(label.withColumnRenamed("node", "fp"), "fp"), "linked-classes")
    least = joined.groupBy("label").agg(F.min("root").alias("least"))
    linked = joined.join(least, "label").select("fp", "label", "least")
    named = classes.join(linked, "fp", "left").select(
        "fp", F.coalesce("label", "fp").alias("label"), F.coalesce("least", "root").alias("component_id"))
    return rows, stage(named, "named-classes")


def deduplicate(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component, columns unchanged: the one with the smallest doc_id, of several texts with that
    id the one with the smallest text hash, of equal rows any one. So a row goes only if a row it is linked
    to stays, whatever other rows share its doc_id. Rows without a doc_id cannot be told apart as
    documents and stay."""
    rows, named = _components(docs, shingle, max_bits, tagged=True)
    texts = (rows.where("doc_id IS NOT NULL").join(named.select("fp", "label"), "fp")
             .groupBy("label", "doc_id", "tag").agg(F.count(F.lit(1)).alias("n")))
    texts = stage(texts, "component-rows")
    best = texts.groupBy("label").agg(F.min(F.struct("doc_id", "tag")).alias("best"))
    judged = texts.join(best, "label").withColumn("stays", F.struct("doc_id", "tag") == F.col("best"))
    # rows of one doc_id and text that are in two components cannot be: equal texts have one fingerprint
    judged = stage(judged.where("NOT stays OR n > 1").select(F.col("doc_id").alias("_i"), F.col("tag").alias("_t"), "stays"), "judged-rows")

    def this(rows):
        return (docs["doc_id"].cast("long") == rows["_i"]) & (F.xxhash64(docs["text"]) == rows["_t"])

    alone = docs.join(judged, this(judged), "left_anti")
    several = judged.where("stays")
    repeated = docs.join(several, this(several), "left_semi")
    # the whole row travels as one struct, so no column name can clash
    whole = repeated.select(docs["doc_id"].alias("_i"), F.xxhash64(docs["text"]).alias("_t"),
                            F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_doc"))
    once = whole.groupBy("_i", "_t").agg(F.first("_doc").alias("_doc")).select("_doc.*")
    return alone.unionByName(once)


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
