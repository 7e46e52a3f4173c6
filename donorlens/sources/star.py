"""Derive the four contribution tables from the TPC-H-style star schema.

The test data ships region, nation, customer, supplier, part, orders and
lineitem. This module maps them onto the contribution contract with plain
DataFrame joins and column expressions, so every report's work grows with
the star tables. The expressions are a fixed mapping (see FIXTURES.md).

Scale notes: lineitem and orders are the two big inputs and are joined on the
order key (a sort-merge join, one shuffle each side, once orders exceeds the
broadcast threshold); customer and part are joined by key and
left to Spark's size-checked join selection (broadcast under the threshold,
sort-merge beyond it). nation and region are fixed-size code tables
(25 and 5 rows by the TPC-H definition) and are broadcast explicitly.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from donorlens.sources.tables import ContributionTables

STAR_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

# Fixed values of the mapping: the election cycles every supplier stands in,
# the brand left out of the industry codes, and the party codes by residue.
CANDIDATE_CYCLES = [1996, 1998, 2000, 2002]
UNMATCHED_BRAND = "Brand#9"
SUPPLIER_PARTY_BY_NATION_MOD4 = ["D", "R", "L", ""]
COMMITTEE_PARTY_BY_SIZE_MOD4 = ["D", "R", "", "I"]


# The star columns the mapping reads, with their stored types. Declaring them
# skips schema inference (one footer-reading job per table) and prunes the
# scan to these columns from the start.
STAR_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_size INT",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_returnflag STRING",
}


def read_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: spark.read.schema(STAR_SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))
            for name in STAR_TABLES}


def _padded(prefix: str, key, width: int):
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), width, "0"))


def _by_residue(c, values):
    """case c when 0 then values[0] when 1 then values[1] ... end"""
    out = None
    for i, v in enumerate(values):
        out = F.when(c == i, F.lit(v)) if out is None else out.when(c == i, F.lit(v))
    return out


def contributions_from_star(star: dict[str, DataFrame]) -> DataFrame:
    li = star["lineitem"].select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                 "l_quantity", "l_returnflag")
    orders = star["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    customer = star["customer"].select("c_custkey", "c_nationkey")
    nation = F.broadcast(star["nation"].select("n_nationkey", "n_name", "n_regionkey"))
    region = F.broadcast(star["region"].select("r_regionkey", "r_name"))
    part = star["part"].select("p_partkey", "p_brand")

    # Join strategies come from scan statistics: at scale lineitem and orders
    # (both fact tables) are sort-merge joined on the order key; customer and
    # part are joined on their own so their sizes decide broadcast or shuffle;
    # the code tables join last, map-side.
    base = (li.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(customer, F.col("o_custkey") == F.col("c_custkey"))
            .join(part, F.col("l_partkey") == F.col("p_partkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey")))

    # The column mapping, as SQL expressions (one JVM call for all of them).
    contributions = base.selectExpr(
        "CASE WHEN o_custkey % 97 = 0 THEN '' "
        "ELSE concat('U', lpad(CAST(o_custkey AS STRING), 10, '0')) END AS contributor_id",
        # contributors start in different years, so that first cycles vary
        "CAST(greatest(year(o_orderdate), 1995 + o_custkey % 7) "
        "+ greatest(year(o_orderdate), 1995 + o_custkey % 7) % 2 AS INT) AS cycle",
        # recipients outside the dimensions, some with neither prefix
        "CASE WHEN l_linenumber % 3 = 0 AND l_partkey % 22 = 0 THEN concat('X', lpad(CAST(l_partkey AS STRING), 8, '0')) "
        "WHEN l_linenumber % 3 = 0 AND l_partkey % 11 = 0 THEN concat('CX', lpad(CAST(l_partkey AS STRING), 8, '0')) "
        "WHEN l_linenumber % 3 = 0 THEN concat('C', lpad(CAST(l_partkey AS STRING), 8, '0')) "
        "ELSE concat('N', lpad(CAST(l_suppkey AS STRING), 8, '0')) END AS recipient_id",
        "CAST(o_orderdate AS DATE) AS date",
        "CAST(CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -1 ELSE 1 END * "
        "CASE o_custkey % 4 WHEN 0 THEN floor(l_quantity / 5) WHEN 3 THEN l_quantity * 10 "
        "ELSE l_quantity END AS INT) AS amount",
        "CASE WHEN p_brand = '%s' THEN 'none' ELSE p_brand END AS real_code" % UNMATCHED_BRAND,
        "concat('C', lpad(CAST(l_partkey AS STRING), 8, '0')) AS committee_id",
        "CASE WHEN l_linenumber % 5 = 0 THEN concat('C', lpad(CAST(l_suppkey AS STRING), 8, '0')) "
        "ELSE '' END AS other_id",
        "CASE WHEN l_linenumber = 2 AND o_custkey % 13 = 0 THEN '' WHEN o_custkey % 5 IN (0, 2) THEN 'F' "
        "WHEN o_custkey % 5 IN (1, 3) THEN 'M' ELSE 'N' END AS gender",
        "n_name AS city",
        "r_name AS state",
        "lpad(CAST(c_nationkey AS STRING), 5, '0') AS zip",
        # rows of every 50th part appear twice: genuine duplicate contributions
        "explode(array_repeat(true, CASE WHEN l_partkey % 50 = 0 THEN 2 ELSE 1 END)) AS _copy",
    )
    return contributions.drop("_copy")


def candidates_from_star(star: dict[str, DataFrame]) -> DataFrame:
    s = star["supplier"].select("s_suppkey", "s_nationkey")
    s = s.select("s_suppkey", "s_nationkey",
                 F.explode(F.array(*[F.lit(c) for c in CANDIDATE_CYCLES])).alias("cycle"))
    party = (F.when((F.col("s_suppkey") % 10 == 0) & (F.col("cycle") >= 2000), F.lit("I"))
             .otherwise(_by_residue(F.col("s_nationkey") % 4, SUPPLIER_PARTY_BY_NATION_MOD4)))
    return s.select(_padded("N", "s_suppkey", 8).alias("cid"), party.alias("party"),
                    F.col("cycle").cast("int").alias("cycle"))


def committees_from_star(star: dict[str, DataFrame]) -> DataFrame:
    p = star["part"]
    return p.select(_padded("C", "p_partkey", 8).alias("committee_id"),
                    F.col("p_name").alias("pac_short"),
                    _by_residue(F.col("p_size") % 4, COMMITTEE_PARTY_BY_SIZE_MOD4).alias("party"))


def industry_codes_from_star(star: dict[str, DataFrame]) -> DataFrame:
    from pyspark.sql import Window

    # The brand vocabulary is a bounded code list; numbering it needs one
    # ordered pass, which only ever sees the distinct brands.
    brands = (star["part"].select("p_brand").distinct())
    return brands.select(
        F.row_number().over(Window.orderBy("p_brand")).cast("int").alias("id"),
        F.col("p_brand").alias("category_code"),
        F.substring("p_brand", 1, 7).alias("industry_code"),
        F.when(F.length("p_brand") == 7, F.lit("Sector A")).otherwise(F.lit("Sector B")).alias("sector"),
    )


def tables_from_star(star: dict[str, DataFrame]) -> ContributionTables:
    return ContributionTables(
        candidates=candidates_from_star(star),
        committees=committees_from_star(star),
        industry_codes=industry_codes_from_star(star),
        individual_contributions=contributions_from_star(star),
    )


def load_star_tables(spark: SparkSession, sf_dir: str) -> ContributionTables:
    """The contribution tables of one test-data directory (lazy)."""
    return tables_from_star(read_star(spark, sf_dir))
