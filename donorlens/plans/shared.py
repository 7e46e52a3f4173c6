"""All reports from one pass over the contributions.

``fold`` reduces the contributions to one row per (contributor, cycle, recipient, committee, other
id, industry code) with the states of every segment and measure. It is combined map-side, so the
joins with the party and code tables see folded rows, however many contributions a hot recipient
or code has. ``store`` writes the folded rows once to shared storage, on request bucketed by
contributor, and ``all_reports`` derives the six reports from them in two steps:

1. the ranks of candidates and committees (aggregates to (cycle, id), at most k per cycle kept);
2. one grouping-sets plan over the folded rows with party, sector, ranked candidate and ranked
   committee attached: one scan, one pair of contributor windows, all groupings.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from donorlens.functions.expressions import is_candidate
from donorlens.operators import industry, parties, topk
from donorlens.operators.rollup import grouping_report, is_pre_aggregated, pre_aggregate
from donorlens.operators.segments import DEFAULT_MEASURES, DEFAULT_SEGMENTS
from donorlens.session import scratch_path
from donorlens.sources.tables import ContributionTables

FOLD_BY = ["contributor_id", "cycle", "recipient_id", "committee_id", "other_id", "real_code"]

BUCKET_ROWS = 1_000_000
GROUP_ROWS = 125_000  # folded rows whose contributors' rows in all groupings a task holds

# A write's shuffle files go with it. Its tasks are half the usual size: a fold holds two tables of its rows.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m"}

# Report name to the grouping it is cut from.
GROUPINGS = {
    "by_cycle": ["cycle"],
    "by_cycle_by_party": ["cycle", "party"],
    "top_candidates_by_cycle": ["cycle", "cid"],
    "top_committees_by_cycle": ["cycle", "top_committee"],
    "by_sector_by_cycle": ["cycle", "sector"],
    "by_sector_by_party_by_cycle": ["cycle", "sector", "party"],
}


def fold(tables: ContributionTables, by: list[str] = FOLD_BY, *, segments=DEFAULT_SEGMENTS,
         measures=DEFAULT_MEASURES) -> ContributionTables:
    """The tables with folded contributions (lazy). Every spec-mode report takes them; a report
    can only use the columns in ``by``. A fold by all of ``FOLD_BY`` combines little, since such keys are nearly
    unique: its rows are shuffled to their keys as they are, once, and its tables are not built beside the
    sorts of a join. A coarser one is combined in each task before its shuffle."""
    facts = tables.contributions
    if set(FOLD_BY) <= set(by):
        facts = facts.repartition(*by)
    return tables.with_contributions(pre_aggregate(facts, by, segments=segments, measures=measures))


@contextmanager
def _writing(spark: SparkSession) -> Iterator[None]:
    old = {key: spark.conf.get(key, None) for key in WRITING}
    for key, value in WRITING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def store(tables: ContributionTables, buckets: int | None = None) -> ContributionTables:
    """Write the contributions (folded or not) once to the shared folder and read that copy.

    With ``buckets`` the copy is a table bucketed and sorted by contributor: level 1 of a report
    without dimension joins and its contributor windows then need no exchange of it. A
    contributor's rows are in one bucket, so fold first where one contributor has a large share.
    ``buckets`` is the least number: it grows with the rows, at most about ``BUCKET_ROWS`` in one,
    since a bucket is sorted, and later grouped, in one task.
    """
    spark = tables.contributions.sparkSession
    name = f"contributions_{uuid.uuid4().hex}"
    path = scratch_path(spark, name)
    rows = tables.contributions
    if buckets:
        rows = _stored(rows, name)  # counted before it is bucketed
        buckets = max(buckets, -(-rows.count() // BUCKET_ROWS))
        (rows.repartition(buckets, "contributor_id").write.format("parquet").option("path", path)
         .bucketBy(buckets, "contributor_id").sortBy("contributor_id").saveAsTable(name))
        return tables.with_contributions(spark.table(name))
    with _writing(spark):
        rows.write.parquet(path)
    return tables.with_contributions(spark.read.schema(rows.schema).parquet(path))


def _stored(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    with _writing(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def all_reports(tables: ContributionTables, *, k: int = 20, attribution: str = "committee", keep_unmatched: bool = False,
                segments=DEFAULT_SEGMENTS, measures=DEFAULT_MEASURES) -> dict[str, DataFrame]:
    """Name to report, as ``reports.generate_reports`` gives them in spec mode. ``tables`` should be stored;
    what the reports have in common is computed here, each report then reads its few rows."""
    facts = tables.contributions
    tags = {"cid": F.when(is_candidate("recipient_id"), F.col("recipient_id")),
            "top_committee": topk.committee_expr(attribution)}
    committees = parties.committee_dimension(tables).withColumnRenamed("committee_id", "top_committee")
    dimensions = {"cid": (parties.candidate_parties(tables), ["cid", "cycle"]), "top_committee": (committees, ["top_committee"])}
    ranked = {}
    for column, tag in tags.items():
        top = topk.top_recipients(facts, tag, column, k).select("cycle", column, "rank")
        dimension, on = dimensions[column]
        ranked[column] = _stored(top.join(dimension, on, "left"), f"top-{column}")
    rows = industry.attribute_sector(tables, parties.attribute_spec(tables, facts), keep_unmatched=keep_unmatched)
    for column, tag in tags.items():
        rows = topk.tag_top(rows, tag, ranked[column], column)
    partitions = 1 + facts.count() // GROUP_ROWS if is_pre_aggregated(facts) else None
    both = _stored(grouping_report(rows, GROUPINGS, segments=segments, measures=measures, partitions=partitions), "all-reports")

    statistics = [c for c in both.columns if c not in ("grouping", "cycle", "party", "cid", "top_committee", "sector")]
    out = {}
    for name, keys in GROUPINGS.items():
        report = both.where(F.col("grouping") == name).select(*keys, *statistics)
        tag = next((c for c in tags if c in keys), None)
        if tag:  # k x cycles rows
            own = [c for c in ranked[tag].columns if c not in ("cycle", tag, "rank")]
            label = F.col(tag).alias("committee_id" if tag == "top_committee" else tag)
            report = report.join(F.broadcast(ranked[tag]), ["cycle", tag]).select(
                "cycle", "rank", label, *[c for c in ("pac_short", "party") if c in own], *statistics)
        out[name] = report
    return out


def long_form(reports: dict[str, DataFrame]) -> DataFrame:
    """All reports in one table: (report, cycle, rank, party, sector, recipient, statistics), NULL
    where a report has no such key."""
    out = None
    for name, report in reports.items():
        recipient = next((c for c in ("cid", "committee_id") if c in report.columns), None)
        keys = {"cycle": "int", "rank": "int", "party": "string", "sector": "string"}
        statistics = [c for c in report.columns if c not in (*keys, "cid", "committee_id", "pac_short")]
        one = report.select(
            F.lit(name).alias("report"),
            *[(F.col(c) if c in report.columns else F.lit(None)).cast(kind).alias(c) for c, kind in keys.items()],
            (F.col(recipient) if recipient else F.lit(None)).cast("string").alias("recipient"), *statistics)
        out = one if out is None else out.unionByName(one)
    return out
