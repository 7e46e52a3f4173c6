"""Merkle manifest of a document table, and its verification by a recursive climb.

1. *Leaves.* One narrow pass hashes every row as it is and as the tampering leaves it. Texts go
   no further. Leaves are numbered by a range sort on (source, doc_id, leaf), so the rows of a hot
   source spread over as many tasks as they fill.
2. *Levels.* ``BATCH`` levels at a time: nodes are grouped by the subtree they fall into (at most
   ``ARITY ** BATCH`` of them), and its levels are folded inside the row. Every node is stored as a
   row linked to its parent, with the digests of its siblings to the left and to the right. The
   subroots are linked into the tree over the sources the same way, so one chain of parent links
   leads from any leaf to the root.
3. *Climb.* A recursive Spark SQL query starts one row per leaf with the tampered digest, joins the
   node row it stands on, appends that node's siblings and folds them in. It runs twice: below the
   nodes with many leaves under them (no join key there has more rows than that), then above, where
   the nodes are few enough for Spark's own size check to broadcast them.

The proof is assembled from the appended rows, one per level (about log3 of the rows).

Defined results: nulls encode as ``-``; a null source is its own group and comes first, as does a
null doc_id in it; an empty text is not a null one; rows that share a doc_id are ordered by their
leaf digest, equal rows are separate leaves with equal digests in any order; an empty table gives no rows; extra
columns are ignored whatever their names; a text of any length is hashed whole, in its own row.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from donorlens.llm.common import exactly, stage

ARITY = 3
BATCH = 6                # levels built by one shuffle
HEIGHT_BITS = 56         # a node id is (level << 56) + place; source trees use levels from 0, the root tree from 64
ROOT_TREE = 64
MANY_LEAVES = 20_000     # nodes with more leaves are climbed in the second run ...
MANY_NODES = 20_000      # ... or with more than the table's rows over this, so that those stay few
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(column: str) -> str:
    text = f"CAST({column} AS STRING)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE concat(octet_length({text}), ':', {text}) END"


def leaf_expr(text: str = "text") -> str:
    """H of a row: SQL over the five columns, ``text`` taken from the given expression."""
    parts = [encoded(f"`{c}`") for c in COLUMNS[:-1]] + [encoded(text)]
    return f"sha2(concat({', '.join(parts)}), 256)"


# Where the checksum of the id is even, the line feeds are gone.
TAMPERED_TEXT = "IF(crc32(CAST(CAST(`doc_id` AS STRING) AS BINARY)) % 2 = 0, replace(`text`, '\\n', ''), `text`)"


def numbered(df: DataFrame, order: list[str], name: str, label: str) -> DataFrame:
    """``df`` with a dense number from 0 in the given order, staged. A range sort, then one offset
    per partition: no task holds more than its range."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id())
    rows = stage(dealt, label).withColumn("_part", F.shiftright("_m", 33))
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition of the range sort
    before = sizes.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).drop("_n")
    return (rows.join(F.broadcast(before), "_part")
            .withColumn(name, F.col("_before") + F.col("_m").bitwiseAND((1 << 33) - 1))
            .drop("_m", "_part", "_before"))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, src, leaf, changed, place, first, size, ord): digests of the row as it is and tampered,
    its dense number, and the first number, row count and rank of its source."""
    hashed = exactly(docs, *COLUMNS).selectExpr(
        "doc_id", "coalesce(concat('s', source), 'n') AS src",   # bytewise order, null first
        f"{leaf_expr()} AS leaf", f"{leaf_expr('(' + TAMPERED_TEXT + ')')} AS changed")
    # the row number spreads repeated rows over the range sort
    hashed = stage(hashed.withColumn("_row", F.monotonically_increasing_id()), "manifest-leaves")
    placed = numbered(hashed, ["src", "doc_id", "leaf", "_row"], "place", "manifest-order").drop("_row")
    sources = placed.groupBy("src").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    sources = numbered(sources, ["src"], "ord", "manifest-sources")
    return stage(placed.join(sources, "src"), "manifest-placed")


def height(size: str) -> str:
    """SQL: levels above the leaves of a tree, the least h with ARITY ** h >= size."""
    powers = ", ".join(f"{ARITY ** h}L" for h in range(39))
    return f"size(filter(array({powers}), x -> x < {size}))"


def _node(level: str, place: str) -> str:
    return f"shiftleft(CAST({level} AS BIGINT), {HEIGHT_BITS}) + {place}"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


LINKED = "node long, parent long, before binary, after binary, under long, parent_under long"


def levels(bottom: DataFrame, base: int, label: str) -> tuple[DataFrame, DataFrame]:
    """The trees over ``bottom`` (first, size, at, id, digest, under): per tree, told apart by
    ``first``, ``size`` nodes with places ``at`` from 0; ``under`` counts the leaves below a node.

    Returns the parent-linked rows (node, parent, before, after, under, parent_under) of all nodes
    below the tops, and the tops (first, id, digest, under). ``base`` is the level of ``bottom`` in
    the ids of the nodes above it.
    """
    spark = bottom.sparkSession
    span = ARITY ** BATCH
    nodes = bottom.withColumn("tall", F.expr(height("size")))
    highest = bottom.agg(F.max(F.expr(height("size")))).first()[0] or 0
    tops, linked, done = [], [spark.createDataFrame([], LINKED)], 0
    while True:
        tops.append(nodes.where(F.col("tall") == done).select("first", "id", "digest", "under"))
        if done >= highest:
            return _union(linked), _union(tops)
        rise = min(BATCH, highest - done)
        # n0 .. n{rise}: the levels of one block of places; a tree that ends in it stops at its top
        inside = (nodes.where(F.col("tall") > done)
                  .groupBy("first", "tall", F.expr(f"at div {span}L").alias("block"))
                  .agg(F.sort_array(F.collect_list(F.struct("at", "id", "digest", "under"))).alias("n0")))
        for i in range(1, rise + 1):
            run = f"slice(n{i - 1}, {ARITY} * j + 1, {ARITY})"
            at = f"block * {span // ARITY ** i}L + j"
            inside = inside.withColumn(f"n{i}", F.expr(
                f"IF(tall < {done + i}, slice(n{i - 1}, 1, 0), "
                f"transform(sequence(0, (size(n{i - 1}) - 1) div {ARITY}), j -> struct({at} AS at, "
                f"{_node(str(base + done + i), f'first + {at}')} AS id, "
                f"sha2(array_join(transform({run}, x -> x.digest), ''), 256) AS digest, "
                f"aggregate({run}, 0L, (s, x) -> s + x.under) AS under)))"))
        inside = stage(inside, f"{label}-{done}")
        for i in range(rise):
            kids = inside.where(F.col("tall") > done + i).selectExpr(f"n{i} AS n", f"n{i + 1} AS up", f"posexplode(n{i}) AS (j, x)")
            run = f"slice(n, {ARITY} * (j div {ARITY}) + 1, {ARITY})"
            text = "unhex(array_join(transform(slice({}, {}, {}), y -> y.digest), ''))"
            linked.append(kids.selectExpr(
                "x.id AS node", f"get(up, j div {ARITY}).id AS parent",
                f"{text.format(run, 1, f'j % {ARITY}')} AS before", f"{text.format(run, f'j % {ARITY} + 2', ARITY)} AS after",
                "x.under AS under", f"get(up, j div {ARITY}).under AS parent_under"))
            if i:
                ended = inside.where(F.col("tall") == done + i).select("first", F.explode(f"n{i}").alias("x"))
                tops.append(ended.select("first", "x.id", "x.digest", "x.under"))
        nodes = inside.select("first", "tall", F.explode(f"n{rise}").alias("x")).select("first", "tall", "x.*")
        done += rise


@contextmanager
def _any_number_of_rows(spark: SparkSession):
    """The recursive query makes a row per leaf and level; Spark's default bound is a million."""
    key = "spark.sql.cteRecursionRowLimit"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def climb(start: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of a recursive ascent from ``start`` (leaf, node, step, siblings, folded, last) along
    the parent links of ``nodes`` (node, parent, before, after, last), staged."""
    spark = start.sparkSession
    tag = uuid.uuid4().hex
    start.createOrReplaceTempView(f"start_{tag}")
    nodes.createOrReplaceTempView(f"nodes_{tag}")
    fold = "sha2(concat(lower(hex(n.before)), lower(hex(c.folded)), lower(hex(n.after))), 256)"
    query = f"""
        WITH RECURSIVE climb (leaf, node, step, siblings, folded, last) AS (
          SELECT leaf, node, step, siblings, folded, last FROM start_{tag}
          UNION ALL
          SELECT c.leaf, n.parent, c.step + 1, concat(n.before, n.after), unhex({fold}), n.last
          FROM climb c JOIN nodes_{tag} n ON c.node = n.node
        )
        SELECT * FROM climb"""
    try:
        with _any_number_of_rows(spark):
            return stage(spark.sql(query), "manifest-climb")
    finally:
        spark.catalog.dropTempView(f"start_{tag}")
        spark.catalog.dropTempView(f"nodes_{tag}")


def manifest(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, str | None]:
    """(leaves, linked node rows, source tops, root digest); the tables are staged."""
    placed = leaves(docs)
    bottom = placed.selectExpr("first", "size", "place - first AS at", "place AS id", "leaf AS digest", "1L AS under")
    low, tops = levels(bottom, 0, "manifest-levels")
    ranks = placed.select("first", "ord").distinct()
    tops = stage(tops.join(ranks, "first"), "manifest-subroots")
    sources = tops.count()
    upper = tops.selectExpr("0L AS first", f"{sources}L AS size", "ord AS at", "id", "digest", "under")
    high, root = levels(upper, ROOT_TREE, "manifest-root")
    found = root.select("digest").first()
    return placed, stage(low.unionByName(high), "manifest-nodes"), tops, found and found[0]


def verify(docs: DataFrame, many_leaves: int = MANY_LEAVES, many_nodes: int = MANY_NODES) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per document, its
    tampered leaf folded with the siblings the manifest has stored."""
    placed, nodes, tops, root = manifest(docs)
    total = placed.count()
    # below this many leaves a node is climbed in the first run; the root never is
    bound = min(max(many_leaves, total // many_nodes), total - 1)
    linked = nodes.withColumn("last", F.col("parent_under") > bound)
    start = placed.selectExpr("place AS leaf", "place AS node", "0 AS step", "CAST(NULL AS BINARY) AS siblings",
                              "unhex(changed) AS folded", f"{str(total == 1).lower()} AS last")
    below = climb(start, linked.where(F.col("under") <= bound))
    again = below.where("last").withColumn("siblings", F.lit(None).cast("binary"))
    above = climb(again, linked.where(F.col("under") > bound))
    steps = below.unionByName(above).groupBy("leaf").agg(
        F.collect_list(F.expr("IF(siblings IS NULL, NULL, struct(step, siblings))")).alias("path"),
        F.max_by("folded", "step").alias("folded"))
    proof = "sha2(array_join(transform(sort_array(path), x -> lower(hex(x.siblings))), ''), 256)"
    folded = steps.selectExpr("leaf AS place", f"{proof} AS proof_sha256", "lower(hex(folded)) AS folded_root")
    subroots = tops.select("first", F.col("digest").alias("subroot"))
    return (placed.select("doc_id", "leaf", "place", "first").join(folded, "place").join(subroots, "first")
            .select("doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root",
                    (F.col("folded_root") == F.lit(root).cast("string")).alias("verified")))


def query(docs: DataFrame) -> DataFrame:
    return verify(docs)
