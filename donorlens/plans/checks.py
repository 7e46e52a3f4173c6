"""Data-quality checks and plan assertions.

Quality checks are DataFrames (one action each when consumed). Plan
assertions inspect ``explain`` text of a plan, the public way to see what
Catalyst chose; they never execute the plan.
"""

from __future__ import annotations

import contextlib
import io
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from donorlens.sources.tables import ContributionTables


def key_violations(report: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once: must be empty for a report."""
    return report.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def key_violation_summary(reports: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(report, violations) for several reports in one plan."""
    parts = [report.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
             .agg(F.count(F.when(F.col("_rows") > 1, 1)).cast("long").alias("violations"))
             .select(F.lit(name).alias("report"), "violations")
             for name, (report, keys) in reports.items()]
    return reduce(DataFrame.unionByName, parts)


def dimension_conflicts(tables: ContributionTables) -> DataFrame:
    """(table, conflicting_keys): keys the reports assume unique but that repeat with different values."""
    cand = (tables.candidates.groupBy("cid", "cycle").agg(F.count_distinct("party").alias("_v"))
            .agg(F.count(F.when(F.col("_v") > 1, 1)).cast("long").alias("conflicting_keys"))
            .select(F.lit("candidates").alias("table_name"), "conflicting_keys"))
    comm = (tables.committees.groupBy("committee_id")
            .agg(F.count_distinct("party", "pac_short").alias("_v"))
            .agg(F.count(F.when(F.col("_v") > 1, 1)).cast("long").alias("conflicting_keys"))
            .select(F.lit("committees").alias("table_name"), "conflicting_keys"))
    codes = (tables.industry_codes.groupBy("category_code").agg(F.count_distinct("sector").alias("_v"))
             .agg(F.count(F.when(F.col("_v") > 1, 1)).cast("long").alias("conflicting_keys"))
             .select(F.lit("industry_codes").alias("table_name"), "conflicting_keys"))
    return cand.unionByName(comm).unionByName(codes)


def load_profile(tables: ContributionTables) -> DataFrame:
    """(table, rows) for every input table, one plan."""
    parts = [df.agg(F.count(F.lit(1)).cast("long").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def assert_plan(df: DataFrame, *, contains: tuple[str, ...] = (), absent: tuple[str, ...] = ()) -> str:
    """Fail if the physical plan lacks any of ``contains`` or has any of ``absent``."""
    text = plan_text(df)
    missing = [c for c in contains if c not in text]
    present = [a for a in absent if a in text]
    if missing or present:
        raise AssertionError(f"plan check failed: missing={missing} present={present}\n{text}")
    return text
