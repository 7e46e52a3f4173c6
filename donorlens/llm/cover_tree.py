"""Embedding near-duplicates by dual traversal of cover trees.

On unit vectors a cosine of at least c is a distance of at most sqrt(2 - 2c), so the triangle
inequality bounds every pair of a node pair by the distance of the centres and the covering radii:

* farther than both radii and the threshold: no pair below links, the node pair is dropped;
* both radii included still within the threshold: every pair below links, counted without a look
  at any (so a group of near copies of any size costs its nodes, not its pairs);
* otherwise the children are paired, down to single vectors, whose cosine is computed in doubles.

Over Spark: equal vectors collapse to one weighted row. A bounded sample gives the centres of the
upper nodes, every vector joins its nearest one, and a node beyond ``NODE_BYTES`` is divided by
hash into nodes with radii of their own. Each node's lower tree is built once: nested levels of
halving radii, every point within its level's radius of its centre, the centres of a level farther
apart than that. The upper node pairs are bounded first; the open ones go to tasks that traverse
both lower trees. Tasks return link counts per vector and a spanning forest, never pairs.

A bound holds whatever the data; how much it prunes depends on them. So a traversal starts at the level
where a sample of its node pairs says it is cheapest. There all node pairs are screened by matrix products,
over the few directions in which the vectors differ most and the length of the rest where that prunes
enough. Vectors that are far apart in many dimensions have no structure to prune beyond that, and
this work grows with the square of such vectors.

Defined results: a vector that is null, empty, zero, or holds null or non-finite components links
with nothing (n_links 0, its own component); vectors of different lengths do not link; repeated rows link
with each other; vectors with equal components link without a computation; a null vec_id counts as a link like any other, is ignored when a component's smallest id is
taken, and is kept only where no id is in the component; extra columns and labels are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, functions as F, types as T

from donorlens.llm.common import by_value, exactly, stage
from donorlens.llm.components import components

THRESHOLD = 0.95
CENTRES = 1024          # upper nodes at most (the sample is this many vectors)
UPPER_NODES = 8         # ... and at least, where there are vectors enough: tasks for the node pairs
NODE_BYTES = 32 << 20   # vectors (as doubles) of an upper node that a task holds
SOLVERS = 4096          # partitions for the node pairs at most
PRODUCTS = 1 << 26      # pairs of vectors that are worth a partition
PAIRS = 1 << 18         # node pairs looked at at once
PROBE = 1024            # nodes of a side that tell how well the bounds of a level prune
COLUMN_NS, PRODUCT_NS, PAIR_NS = 0.03, 0.4, 150  # of a column of a screening product, its result, an open node pair
SLACK = 1e-7            # on distances in bounds: above the rounding of doubles (1.5e-8 near 0) ...
SLACK_32 = 1e-4         # ... and of single-precision products, which only screen; a tenth of it on the products


# -- trees in a task ----------------------------------------------------------------------

def radii(threshold: float) -> list[float]:
    """Halving radii from 1 (half the unit sphere's) to the first below a quarter of the link distance."""
    out = [1.0]
    while out[-1] > np.sqrt(2 - 2 * threshold) / 4:
        out.append(out[-1] / 2)
    return out


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of all rows of ``a`` to all of ``b`` (unit vectors)."""
    return np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0))


def _nearest(x: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``x`` the row of ``points`` with the largest product, and the product."""
    near, best, every = np.zeros(len(x), np.int64), np.full(len(x), -2, x.dtype), np.arange(len(x))
    for j in range(0, len(points), 2048):
        product = x @ points[j:j + 2048].T
        k = product.argmax(axis=1)
        value = product[every, k]
        more = value > best
        near[more], best[more] = k[more] + j, value[more]
    return near, best


def _net(x: np.ndarray, members: np.ndarray, radius: float) -> np.ndarray:
    """For ``members`` (the first is the parent's centre) the member at whose centre each lies: every one
    within ``radius`` of its centre, centres farther apart than that. Blocks by matrix products, in single
    precision against the centres so far; what that leaves open is decided in doubles."""
    owner = np.full(len(members), -1)
    centres: list[int] = []
    own, flat = x[members], x[members].astype(np.float32)
    points, least = np.empty_like(flat), 1 - radius * radius / 2
    for start in range(0, len(members), 512):
        block = np.arange(start, min(start + 512, len(members)))
        if centres:
            near, best = _nearest(flat[block], points[:len(centres)])
            near = np.asarray(centres)[near]
            fits = np.sqrt(((own[block] - own[near]) ** 2).sum(axis=1)) <= radius
            for i in np.flatnonzero(~fits & (best > least - SLACK_32)):
                far = distances(own[block[i:i + 1]], own[centres])[0]
                near[i], fits[i] = centres[far.argmin()], far.min() <= radius
            owner[block[fits]] = near[fits]
            block = block[~fits]
        before = len(centres)
        if len(block):
            inner = distances(own[block], own[block]) <= radius
            inner[np.arange(len(block)), np.arange(len(block))] = True
            alone = inner.sum(axis=1) == 1
            owner[block[alone]] = block[alone]
            centres += block[alone].tolist()
            for i in np.flatnonzero(~alone):
                if owner[block[i]] < 0:
                    owner[block[inner[i] & (owner[block] < 0)]] = block[i]
                    centres.append(int(block[i]))
        points[before:len(centres)] = flat[centres[before:]]
    return members[owner]


def build(x: np.ndarray, threshold: float) -> np.ndarray:
    """The lower tree of ``x``: per vector, its centre on every level (row numbers, coarse to fine)."""
    path = np.empty((len(x), len(radii(threshold))), np.int32)
    parent = np.zeros(len(x), np.int64)
    for level, radius in enumerate(radii(threshold)):
        own = parent.copy()
        # nesting: a centre is the first member of its own node
        order = np.lexsort((np.arange(len(x)) != parent, parent))
        starts = np.flatnonzero(np.r_[True, parent[order][1:] != parent[order][:-1]])
        for a, b in zip(starts, [*starts[1:], len(x)]):
            if b - a > 1:
                members = order[a:b]
                own[members] = _net(x, members, radius)
        path[:, level] = own
        parent = own
    return path


class Tree:
    """Vectors in path order; per level the ranges, centres, radii and weights of its nodes."""

    def __init__(self, x: np.ndarray, path: np.ndarray, weight: np.ndarray):
        order = np.lexsort(path.T[::-1])
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.order, self.x, self.weight = order, x[order], weight[order]
        path = place[path[order]]
        self.starts, self.centres, self.radii, self.children = [], [], [], []
        new = np.r_[True, np.zeros(len(x) - 1, bool)] if len(x) else np.zeros(0, bool)
        total = np.r_[0, np.cumsum(self.weight)]
        self.node_weight = []
        for level in range(path.shape[1]):
            new = new | np.r_[True, path[1:, level] != path[:-1, level]]
            starts = np.flatnonzero(new)
            centre = path[starts, level]
            off = np.flatnonzero(path[:, level] != np.arange(len(x)))
            gap = np.zeros(len(x))
            gap[off] = np.sqrt(((self.x[off] - self.x[path[off, level]]) ** 2).sum(axis=1))
            if self.starts:
                self.children.append(np.searchsorted(starts, np.r_[self.starts[-1], len(x)]))
            self.starts.append(starts)
            self.centres.append(centre)
            self.radii.append(np.maximum.reduceat(gap, starts))
            self.node_weight.append(np.diff(total[np.r_[starts, len(x)]]))
        # single vectors close the tree
        self.children.append(np.r_[self.starts[-1], len(x)])

    def ends(self, level: int) -> np.ndarray:
        return np.r_[self.starts[level][1:], len(self.x)]


class Links:
    """Link counts and a forest over vectors 0..n-1 (places of one or two trees side by side)."""

    def __init__(self, n: int):
        self.count = np.zeros(n + 1, np.int64)
        self.ranged = np.zeros(n + 1, np.int64)    # steps of the counts that whole ranges get
        self.root = np.arange(n)

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        root = self.root
        while len(i):
            a, b = root[i], root[j]
            apart = a != b
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up

    def add_ranges(self, start: np.ndarray, end: np.ndarray, n: np.ndarray) -> None:
        np.add.at(self.ranged, start, n)
        np.subtract.at(self.ranged, end, n)

    def close(self) -> None:
        self.count = (self.count + np.cumsum(self.ranged))[:-1]


def _basis(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Orthogonal columns, those first in which vectors of the two sides differ most."""
    probe = np.concatenate([v[::-(-len(v) // PROBE)] for v in (x, y)])
    return np.linalg.eigh(np.cov(probe.T, bias=True).reshape(probe.shape[1], -1))[1][:, ::-1]


def traverse(one: Tree, two: Tree | None, threshold: float) -> Links:
    """Links between two trees, or inside one (``two`` None), where a vector links to itself, too."""
    same = two is None
    other = one if same else two
    n, reach = len(one.x), np.sqrt(2 - 2 * threshold)
    shift = 0 if same else n
    links = Links(n + (0 if same else len(other.x)))
    last = len(one.starts) - 1
    whole_nodes = [[np.zeros(len(s), bool) for s in t.starts] for t in (one, other)]
    # one level below the last stand the single vectors
    centres = [[*t.centres, np.arange(len(t.x))] for t in (one, other)]
    radius = [[*t.radii, np.zeros(len(t.x))] for t in (one, other)]

    counts = [[len(c) for c in side] for side in centres]
    basis = _basis(one.x, other.x)
    lead = basis.shape[1]  # the columns of a screening product

    def columns(side, level, lead, at=slice(None)):
        """Nodes of a level as rows whose product, of a row of side 0 and one of side 1, is at least 1 where the bound
        leaves the pair open: cosine + (radius + radius' + reach) ** 2 / 2, with the product of the lengths
        (never less) for that of the components behind the first ``lead``."""
        x, r = (one, other)[side].x[centres[side][level][at]] @ basis, radius[side][level][at]
        rest = np.sqrt((x[:, lead:] ** 2).sum(axis=1))
        r = r if side else r + reach + SLACK_32
        flat = np.ones(len(r))
        more = (r, r * r / 2, flat) if side else (r, flat, r * r / 2)
        return np.column_stack([x[:, :lead], rest, *more]).astype(np.float32)

    @cache
    def screen(side, level):
        return columns(side, level, lead)

    def open_share(level, lead):
        """The share of a level's node pairs that a screening product leaves open, on evenly spaced nodes."""
        left, right = (columns(side, level, lead, np.unique((np.arange(min(n, PROBE)) + 0.5 * side * (n > PROBE))
                                                            * n // min(n, PROBE)).astype(int)) for side, n in enumerate(
            (counts[0][level], counts[1][level])))
        return np.count_nonzero(left @ right.T >= 1 - SLACK_32 / 10) / (len(left) * len(right))

    def plan():
        """The level at which the traversal starts and the columns of its products: the cheapest by the shares."""
        pairs = [a * b for a, b in zip(*counts)]
        shares = [open_share(level, lead) for level in range(last + 2)]
        below = np.r_[[PAIR_NS * s * n for s, n in zip(shares[:-1], pairs[1:])], 0][::-1].cumsum()[::-1]
        cost = [(PRODUCT_NS + COLUMN_NS * lead + PAIR_NS * s) * n + more for s, n, more in zip(shares, pairs, below)]
        start = int(np.argmin(cost))
        tried = [m for m in (8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256) if m < lead]
        price = {m: COLUMN_NS * m + PAIR_NS * open_share(start, m) for m in (*tried, lead)}
        return start, min(price, key=price.get)

    def cross(level, a, b):
        """Pairs of two runs of nodes that the bound leaves open, by blocks of a matrix product."""
        left, right = screen(0, level), screen(1, level)
        held, size = [], 0
        for i in range(0, len(a), 512):
            own = a[i:i + 512]
            for j in range(0, len(b), 1024):
                far = b[j:j + 1024]
                if same and far[-1] < own[0]:
                    continue
                hit = left[own] @ right[far].T >= 1 - SLACK_32 / 10
                rows = np.flatnonzero(hit.any(axis=1))
                x, y = np.divmod(np.flatnonzero(hit[rows]), len(far))
                x, y = own[rows[x]], far[y]
                if same:
                    once = x <= y
                    x, y = x[once], y[once]
                held.append((x, y))
                size += len(x)
                if size >= PAIRS:
                    yield from whole(level, held)
                    held, size = [], 0
        if size:
            yield from whole(level, held)

    def whole(level, held):
        x, y = (np.concatenate(c) for c in zip(*held))
        for k in range(0, len(x), PAIRS):
            yield level, x[k:k + PAIRS], y[k:k + PAIRS]

    def children(level, a, b):
        kids_a, kids_b = one.children[level], other.children[level]
        na, nb = kids_a[a + 1] - kids_a[a], kids_b[b + 1] - kids_b[b]
        work = np.cumsum(na * nb)
        begin = 0
        while begin < len(a):
            base = work[begin - 1] if begin else 0
            if work[begin] - base > PAIRS:
                yield from cross(level + 1, np.arange(kids_a[a[begin]], kids_a[a[begin] + 1]),
                                 np.arange(kids_b[b[begin]], kids_b[b[begin] + 1]))
                begin += 1
                continue
            stop = int(np.searchsorted(work, base + PAIRS, "right"))
            grow, wide = (na * nb)[begin:stop], nb[begin:stop]
            at = np.arange(grow.sum()) - np.repeat(np.cumsum(grow) - grow, grow)
            wide = np.repeat(wide, grow)
            ca = np.repeat(kids_a[a[begin:stop]], grow) + at // wide
            cb = np.repeat(kids_b[b[begin:stop]], grow) + at % wide
            if same:
                once = ca <= cb
                ca, cb = ca[once], cb[once]
            yield level + 1, ca, cb
            begin = stop

    def settle(level, a, b):
        """Drops or counts the node pairs that the radii decide; returns the open ones."""
        gap = np.sqrt(np.maximum(2 - 2 * np.einsum("ij,ij->i", one.x[one.centres[level][a]], other.x[other.centres[level][b]]), 0))
        both = one.radii[level][a] + other.radii[level][b]
        whole = gap + both <= reach - SLACK
        x, y = a[whole], b[whole]
        s, e, t, f = one.starts[level][x], one.ends(level)[x], other.starts[level][y], other.ends(level)[y]
        links.add_ranges(s, e, other.node_weight[level][y])
        two_sided = (x != y) if same else np.ones(len(x), bool)
        links.add_ranges(t[two_sided] + shift, f[two_sided] + shift, one.node_weight[level][x[two_sided]])
        links.join(s, t + shift)
        whole_nodes[0][level][x] = True
        whole_nodes[1][level][y] = True
        keep = ~whole & (gap <= both + reach + SLACK)
        return a[keep], b[keep]

    def look(i, j):
        """Single vectors: the cosine itself."""
        hit = (np.einsum("ij,ij->i", one.x[i], other.x[j]) >= threshold) | ((i == j) & same)
        i, j = i[hit], j[hit]
        np.add.at(links.count, i, other.weight[j])
        two_sided = (i != j) if same else np.ones(len(i), bool)
        np.add.at(links.count, j[two_sided] + shift, one.weight[i[two_sided]])
        links.join(i, j + shift)

    start, lead = plan()
    stack = [cross(start, *(np.arange(side[start]) for side in counts))]
    while stack:
        pairs = next(stack[-1], None)
        if pairs is None:
            stack.pop()
        elif pairs[0] > last:
            look(*pairs[1:])
        else:
            a, b = settle(*pairs)
            if len(a):
                stack.append(children(pairs[0], a, b))
    for tree, marks, at in ((one, whole_nodes[0], 0), (other, whole_nodes[1], shift)):
        for level, mark in enumerate(marks):
            s, e = tree.starts[level][mark], tree.ends(level)[mark]
            first = np.repeat(s, e - s)
            links.join(first + at, first + at + np.arange(len(first)) - np.repeat(np.cumsum(e - s) - (e - s), e - s))
    links.close()
    return links


# -- over Spark -----------------------------------------------------------------------------

def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in doubles; scaled by their largest component first, so no norm overflows."""
    x = np.asarray(vectors, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _matrix(column: pa.ListArray) -> np.ndarray:
    """The rows of a column of lists of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(key, embedding, dim, weight, root): the usable vectors, equal ones once, with their number of rows
    and smallest vec_id. Staged."""
    broken = "exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity'))"
    usable = rows.where(f"embedding IS NOT NULL AND NOT {broken} AND exists(embedding, x -> x != 0)")
    once = usable.groupBy("embedding").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("root"))
    return stage(once.select(F.monotonically_increasing_id().alias("key"), "embedding",
                             F.size("embedding").alias("dim"), "weight", "root"), "distinct-vectors")


def _assigned(vectors: DataFrame, centres: dict[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Adds the nearest centre of the vector's length (-1: the sample has none) and the distance to it."""
    schema = vectors.select("key", "weight", "dim", "embedding").schema.add("centre", T.IntegerType()).add("gap", T.DoubleType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(2).to_numpy()
            centre, gap = np.full(len(dims), -1, np.int32), np.full(len(dims), 2.0)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if int(dim) in centres:
                    names, points = centres[int(dim)]
                    x = unit(_matrix(batch.column(3).take(pa.array(at))))
                    near = (x @ points.T).argmax(axis=1)
                    centre[at] = names[near]
                    gap[at] = np.sqrt(((x - points[near]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(centre), pa.array(gap)],
                                             names=[*batch.schema.names, "centre", "gap"])

    return vectors.select("key", "weight", "dim", "embedding").mapInArrow(run, schema)


def _members(nodes: DataFrame, threshold: float) -> DataFrame:
    """The vectors of every node (node, key, weight, embedding) with their lower tree: row in the node, path. Staged."""
    schema = T.StructType([*nodes.schema.fields, T.StructField("row", T.IntegerType()),
                           T.StructField("path", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_value(batches, 0):
            path = build(unit(_matrix(table.column("embedding").combine_chunks())), threshold)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(path) + 1) * path.shape[1], pa.int32()), pa.array(path.ravel()))
            grown = pa.Table.from_arrays([*table.columns, pa.array(np.arange(len(path), dtype=np.int32)), flat],
                                         names=[*table.column_names, "row", "path"])
            yield from grown.to_batches(max_chunksize=10_000)

    dealt = nodes.repartition("node").sortWithinPartitions("node")
    return stage(dealt.mapInArrow(run, schema), "cover-trees")


def _solved(sides: DataFrame, threshold: float, partitions: int) -> DataFrame:
    """(key, n, root) of the node pairs in ``sides`` (task, side, row, key, weight, path, embedding). Staged.
    Their work is not told by their bytes, so the number of partitions is fixed here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in by_value(batches, 0):
            side, row = table.column("side").to_numpy(), table.column("row").to_numpy()
            table = table.take(pa.array(np.lexsort((row, side))))
            cut = int((side == 0).sum())
            trees, keys = [], []
            for a, b in ((0, cut), (cut, len(side))):
                if a < b:
                    part = table.slice(a, b - a)
                    path = part.column("path").combine_chunks().flatten().to_numpy().reshape(b - a, -1)
                    tree = Tree(unit(_matrix(part.column("embedding").combine_chunks())), path, part.column("weight").to_numpy())
                    trees.append(tree)
                    keys.append(part.column("key").to_numpy()[tree.order])
            links = traverse(trees[0], trees[1] if len(trees) > 1 else None, threshold)
            key = np.concatenate(keys)
            at = np.flatnonzero(links.count > 0)
            yield pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(links.count[at]), pa.array(key[links.root[at]])],
                                             names=["key", "n", "root"])

    dealt = sides.repartition(partitions, "task").sortWithinPartitions("task")
    return stage(dealt.mapInArrow(run, "key long, n long, root long"), "vector-links")


def vector_links(vectors: DataFrame, threshold: float = THRESHOLD, node_bytes: int = NODE_BYTES,
                 most: int = CENTRES) -> tuple[DataFrame, DataFrame]:
    """Over ``distinct_vectors``: (key, n) with the rows a vector links to, its own included, and
    edges (u, v) between keys whose components are those of all links."""
    spark = vectors.sparkSession
    size = vectors.agg(F.count(F.lit(1)), F.sum(F.col("dim").cast("long"))).first()
    wanted = min(most, max(min(UPPER_NODES, size[0] // 256 + 1), 2 * 8 * (size[1] or 0) // node_bytes))
    sample = vectors.orderBy(F.xxhash64("embedding"), "key").limit(wanted).select("embedding").collect()
    by_dim: dict[int, list] = {}
    for i, (v,) in enumerate(sample):
        by_dim.setdefault(len(v), []).append((i, v))
    centres = {d: (np.array([i for i, _ in vs], np.int32), unit([v for _, v in vs])) for d, vs in by_dim.items()}

    assigned = stage(_assigned(vectors, centres), "assigned-vectors")
    upper = assigned.groupBy("dim", "centre").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("weight"), F.max("gap").alias("radius"), F.min("key").alias("rep"))
    upper = stage(upper.withColumn("parts", F.ceil(F.col("rows") * F.col("dim") * 8 / node_bytes)), "upper-nodes")

    # upper node pairs: the sampled centres, on the driver; vectors of an unsampled length only meet their own
    known = {r["centre"]: r for r in upper.where("centre >= 0").collect()}
    reach = np.sqrt(2 - 2 * threshold)
    extra = {c: 0 for c in known}
    open_, edges = [], []
    for names, points in centres.values():
        gap = distances(points, points)
        radius = np.array([known[c]["radius"] if c in known else -10.0 for c in names.tolist()])
        apart = gap - radius[:, None] - radius[None, :]
        both = gap + radius[:, None] + radius[None, :]
        for i, j in zip(*np.nonzero(np.triu(apart <= reach + SLACK))):
            a, b = int(names[i]), int(names[j])
            if a not in known or b not in known:
                continue
            if both[i, j] <= reach - SLACK or (a == b and 2 * radius[i] <= reach - SLACK):
                extra[a] += known[b]["weight"]
                if a != b:
                    extra[b] += known[a]["weight"]
                edges.append((known[a]["rep"], known[b]["rep"]))
            else:
                open_.append((a, b))

    key = "(CAST(dim AS BIGINT) << 40) + (CAST(centre + 1 AS BIGINT) << 20) + part"
    nodes = (assigned.join(upper.select("dim", "centre", "parts"), ["dim", "centre"])
             .withColumn("part", F.expr("pmod(xxhash64(key), parts)")).selectExpr(f"{key} AS node", "key", "weight", "embedding"))
    pairs = spark.createDataFrame(open_, "a int, b int")
    parts = upper.select("dim", "centre", F.explode(F.expr("sequence(0L, parts - 1)")).alias("part")).selectExpr(
        "dim", "centre", "part", f"{key} AS node")
    first = parts.select(F.col("centre").alias("a"), F.col("part").alias("part_a"), F.col("node").alias("node_a"))
    second = parts.select(F.col("centre").alias("b"), F.col("part").alias("part_b"), F.col("node").alias("node_b"))
    tasks = pairs.join(first, "a").join(second, "b").where("a < b OR part_a <= part_b").select("node_a", "node_b")
    lone = parts.where("centre = -1").select("dim", "part", "node")
    tasks = tasks.unionByName(
        lone.select("dim", F.col("part").alias("part_a"), F.col("node").alias("node_a"))
        .join(lone.select("dim", F.col("part").alias("part_b"), F.col("node").alias("node_b")), "dim")
        .where("part_a <= part_b").select("node_a", "node_b"))
    tasks = stage(tasks.select(F.monotonically_increasing_id().alias("task"), "node_a", "node_b"), "node-pairs")
    sides = tasks.select("task", F.explode(F.expr(
        "IF(node_a = node_b, array(struct(0 AS side, node_a AS node)), "
        "array(struct(0 AS side, node_a AS node), struct(1 AS side, node_b AS node)))")).alias("s")).select("task", "s.*")
    members = _members(nodes, threshold)
    partitions = max(1, min(2 * tasks.count(), 1 + size[0] ** 2 // PRODUCTS, SOLVERS))
    found = _solved(sides.join(members, "node").select("task", "side", "row", "key", "weight", "path", "embedding"), threshold, partitions)

    # upper nodes all of whose vectors link with each other, or with another node's
    added = spark.createDataFrame([(c, int(n), known[c]["rep"]) for c, n in extra.items() if n], "centre int, n long, rep long")
    whole = assigned.select("key", "centre").join(added, "centre")
    counts = found.select("key", "n").unionByName(whole.select("key", "n")).groupBy("key").agg(F.sum("n").alias("n"))
    forest = (found.select(F.col("key").alias("u"), F.col("root").alias("v"))
              .unionByName(whole.select(F.col("key").alias("u"), F.col("rep").alias("v")))
              .unionByName(spark.createDataFrame(edges, "u long, v long")).where("u != v"))
    return counts, forest


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, node_bytes: int = NODE_BYTES,
                    most: int = CENTRES) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``embeddings`` (vec_id, embedding)."""
    if not 0.5 <= threshold < 1:
        raise ValueError("threshold must be in [0.5, 1)")
    rows = exactly(embeddings, "vec_id", "embedding")
    vectors = distinct_vectors(rows)
    counts, forest = vector_links(vectors, threshold, node_bytes, most)
    label = components(forest)
    named = stage(vectors.select("key", "root").join(label.withColumnRenamed("node", "key"), "key", "left")
                  .withColumn("label", F.coalesce("label", "key")).join(counts, "key"), "labelled-vectors")
    least = named.groupBy("label").agg(F.min("root").alias("component_id"))
    classes = stage(named.join(least, "label").select("key", "n", "component_id"), "vector-classes")
    known = vectors.select("key", F.col("embedding").alias("_vector")).join(classes, "key")
    # sorted by a number first: comparing whole vectors is dear
    known = known.withColumn("_hash", F.xxhash64("_vector"))
    found = rows.join(known, (F.xxhash64(rows["embedding"]) == known["_hash"]) & (rows["embedding"] == known["_vector"]), "left")
    component = F.when(F.col("n").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return found.select("vec_id", F.coalesce(F.col("n") - 1, F.lit(0).cast("long")).alias("n_links"),
                        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def query(embeddings: DataFrame) -> DataFrame:
    return near_duplicates(embeddings)
