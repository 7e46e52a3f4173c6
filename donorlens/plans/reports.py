"""The reports: each is one lazy DataFrame plan over the contribution tables."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, functions as F

from donorlens.operators import industry, parties, topk
from donorlens.operators.basic import dealt_out
from donorlens.operators.rollup import segment_report
from donorlens.operators.segments import DEFAULT_MEASURES, DEFAULT_SEGMENTS, Measure, Segment
from donorlens.sources.tables import ContributionTables


def by_cycle(tables: ContributionTables, *, mode: str = "spec",
             segments: list[Segment] = DEFAULT_SEGMENTS,
             measures: list[Measure] = DEFAULT_MEASURES) -> DataFrame:
    """REP-1: one row per election cycle."""
    return segment_report(tables.contributions, ["cycle"], mode=mode, segments=segments, measures=measures)


def by_cycle_by_party(tables: ContributionTables, *, mode: str = "spec",
                      segments: list[Segment] = DEFAULT_SEGMENTS,
                      measures: list[Measure] = DEFAULT_MEASURES) -> DataFrame:
    """REP-2: one row per (cycle, party).

    spec: a contribution belongs to the party of its recipient in that cycle
    (candidates matched on id and cycle, committees on id); contributor totals
    and first cycles come from all contributions.
    as_coded: a recipient belongs to every party it was ever listed under,
    identical contributions count once, and everything is computed inside the
    (cycle, party) group; a group exists only if a recipient with the right
    id prefix proves the party in that cycle.
    """
    keys = ["cycle", "party"]
    if mode == "as_coded":
        # the contributors' table is not built beside that of the distinct contributions
        facts = dealt_out(parties.attribute_as_coded(tables), [*keys, "contributor_id"])
        report = segment_report(facts, keys, mode=mode, segments=segments, measures=measures,
                                carry_max=["proven"])
        return report.where(F.col("proven")).drop("proven")
    facts = parties.attribute_spec(tables)
    return segment_report(facts, keys, mode=mode, segments=segments, measures=measures,
                          attributed=F.col("party").isNotNull())


def top_candidates(tables: ContributionTables, *, k: int = 20,
                   segments: list[Segment] = DEFAULT_SEGMENTS,
                   measures: list[Measure] = DEFAULT_MEASURES) -> DataFrame:
    """REP-3: the k candidates that raised most per cycle, with all statistics."""
    return topk.top_candidates_report(tables, k=k, segments=segments, measures=measures)


def top_committees(tables: ContributionTables, *, k: int = 20, attribution: str = "committee",
                   segments: list[Segment] = DEFAULT_SEGMENTS,
                   measures: list[Measure] = DEFAULT_MEASURES) -> DataFrame:
    """REP-4: the k committees that raised most per cycle, with all statistics."""
    return topk.top_committees_report(tables, k=k, attribution=attribution,
                                      segments=segments, measures=measures)


def by_sector(tables: ContributionTables, *, keep_unmatched: bool = False,
              segments: list[Segment] = DEFAULT_SEGMENTS,
              measures: list[Measure] = DEFAULT_MEASURES) -> DataFrame:
    """REP-5: one row per (cycle, sector)."""
    return industry.by_sector_report(tables, keep_unmatched=keep_unmatched,
                                     segments=segments, measures=measures)


def by_sector_by_party(tables: ContributionTables, *, keep_unmatched: bool = False,
                       segments: list[Segment] = DEFAULT_SEGMENTS,
                       measures: list[Measure] = DEFAULT_MEASURES) -> DataFrame:
    """REP-5 party breakdown, long form: one row per (cycle, sector, party)."""
    return industry.by_sector_by_party_report(tables, keep_unmatched=keep_unmatched,
                                              segments=segments, measures=measures)


def sector_totals_and_parties(tables: ContributionTables, *, keep_unmatched: bool = False,
                              segments: list[Segment] = DEFAULT_SEGMENTS,
                              measures: list[Measure] = DEFAULT_MEASURES) -> DataFrame:
    """REP-5: sector totals and their party breakdown in one report, one row per (cycle, sector) and
    per (cycle, sector, party)."""
    return industry.sector_totals_and_parties(tables, keep_unmatched=keep_unmatched, segments=segments, measures=measures)


def by_sector_pivot(tables: ContributionTables, party_labels: dict[str, str], *,
                    keep_unmatched: bool = False) -> DataFrame:
    """REP-5 party breakdown, wide form: amount and contributors per party as columns."""
    return industry.by_sector_pivot(tables, party_labels, keep_unmatched=keep_unmatched)


# Report registry: name -> (builder, key columns). Order is the run order.
REPORTS: dict[str, tuple[Callable[[ContributionTables], DataFrame], list[str]]] = {
    "by_cycle": (by_cycle, ["cycle"]),
    "by_cycle_by_party": (by_cycle_by_party, ["cycle", "party"]),
    "top_candidates_by_cycle": (top_candidates, ["cycle", "rank"]),
    "top_committees_by_cycle": (top_committees, ["cycle", "rank"]),
    "by_sector_by_cycle": (by_sector, ["cycle", "sector"]),
    "by_sector_by_party_by_cycle": (by_sector_by_party, ["cycle", "sector", "party"]),
}

REPORT_KEYS = {name: keys for name, (_, keys) in REPORTS.items()}


def generate_reports(tables: ContributionTables, names: list[str] | None = None, **options):
    """Yield ``(name, DataFrame)`` lazily, one report at a time.

    Each option goes to the reports that take it (``mode`` only to the two
    reports that have an as-coded variant, ``k`` to the top-k reports, ...); an
    option that no report takes is an error.
    """
    import inspect

    known = {p for builder, _ in REPORTS.values() for p in inspect.signature(builder).parameters}
    if unknown := options.keys() - known:
        raise TypeError(f"no report takes {sorted(unknown)}")
    for name in names or list(REPORTS):
        builder, _ = REPORTS[name]
        accepted = inspect.signature(builder).parameters
        yield name, builder(tables, **{k: v for k, v in options.items() if k in accepted})


def materialise(tables: ContributionTables) -> ContributionTables:
    """Cut the source lineage once before running several reports.

    The normalised contributions are written as a Parquet table to a fresh
    folder under the shared ``spark.checkpoint.dir`` and read back: a lost
    executor never forces a re-read of the source, and every report scans
    only the columns it needs from the columnar copy. Dimensions stay lazy.
    """
    import uuid

    from donorlens.schemas import INDIVIDUAL_CONTRIBUTIONS
    from donorlens.session import scratch_path

    spark = tables.contributions.sparkSession
    path = scratch_path(spark, f"contributions-{uuid.uuid4().hex}")
    tables.contributions.write.mode("error").parquet(path)
    return tables.with_contributions(spark.read.schema(INDIVIDUAL_CONTRIBUTIONS).parquet(path))
