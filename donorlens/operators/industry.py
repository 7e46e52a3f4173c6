"""Industry sector attribution and the by-sector reports.

``real_code`` on a contribution matches ``category_code`` of the industry
codes (no foreign key: unknown codes exist). The code list is a small
dimension; its join is left to Spark's size-checked strategy selection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from donorlens.operators.parties import attribute_spec
from donorlens.operators.rollup import amount_column, grouping_report, segment_report
from donorlens.operators.segments import DEFAULT_MEASURES, DEFAULT_SEGMENTS, Measure, Segment
from donorlens.sources.tables import ContributionTables


def sector_dimension(tables: ContributionTables) -> DataFrame:
    """One sector per category code; a repeated code resolves to the smallest sector."""
    return tables.industry_codes.groupBy("category_code").agg(F.min("sector").alias("sector"))


def attribute_sector(tables: ContributionTables, facts: DataFrame | None = None, *,
                     keep_unmatched: bool = False) -> DataFrame:
    """Contributions with ``sector``: NULL for unknown codes, or '' when ``keep_unmatched``."""
    facts = tables.contributions if facts is None else facts
    # an exchange of its own, not the aggregate's, lets adaptive execution split a hot code
    sectors = sector_dimension(tables).repartition(F.xxhash64("category_code"))
    out = facts.join(sectors, F.col("real_code") == F.col("category_code"), "left")
    out = out.drop("category_code")
    if keep_unmatched:
        out = out.withColumn("sector", F.coalesce(F.col("sector"), F.lit("")))
    return out


def by_sector_report(tables: ContributionTables, *, keep_unmatched: bool = False,
                     segments: list[Segment] = DEFAULT_SEGMENTS,
                     measures: list[Measure] = DEFAULT_MEASURES) -> DataFrame:
    """(cycle, sector, statistics). Contributor totals span all their contributions."""
    facts = attribute_sector(tables, keep_unmatched=keep_unmatched)
    return segment_report(facts, ["cycle", "sector"], segments=segments, measures=measures,
                          attributed=F.col("sector").isNotNull())


def by_sector_by_party_report(tables: ContributionTables, *, keep_unmatched: bool = False,
                              segments: list[Segment] = DEFAULT_SEGMENTS,
                              measures: list[Measure] = DEFAULT_MEASURES) -> DataFrame:
    """(cycle, sector, party, statistics): the sector report broken down by recipient party."""
    facts = attribute_sector(tables, attribute_spec(tables), keep_unmatched=keep_unmatched)
    return segment_report(facts, ["cycle", "sector", "party"], segments=segments, measures=measures,
                          attributed=F.col("sector").isNotNull() & F.col("party").isNotNull())


def sector_totals_and_parties(tables: ContributionTables, *, keep_unmatched: bool = False,
                              segments: list[Segment] = DEFAULT_SEGMENTS,
                              measures: list[Measure] = DEFAULT_MEASURES) -> DataFrame:
    """(breakdown, cycle, sector, party, statistics): per sector its total (party NULL) and its parties,
    from one pass. A contributor to two parties counts once in the sector; '' is a party; contributions
    to unknown recipients are in the total only."""
    facts = attribute_sector(tables, attribute_spec(tables), keep_unmatched=keep_unmatched)
    report = grouping_report(facts, {"sector": ["cycle", "sector"], "party": ["cycle", "sector", "party"]},
                             segments=segments, measures=measures)
    return report.withColumnRenamed("grouping", "breakdown")


def by_sector_pivot(tables: ContributionTables, party_labels: dict[str, str], *,
                    keep_unmatched: bool = False) -> DataFrame:
    """(cycle, sector, {label}_TotalAmountDonated, {label}_TotalContributorSize per party).

    ``party_labels`` maps party codes to column labels ('' is a real party and
    needs a label). Parties outside the map are left out; a missing
    combination is 0.
    """
    facts = attribute_sector(tables, attribute_spec(tables), keep_unmatched=keep_unmatched)
    label = None
    for party, name in party_labels.items():
        cond = F.col("party") == F.lit(party)
        label = F.when(cond, F.lit(name)) if label is None else label.when(cond, F.lit(name))
    facts = facts.withColumn("_label", label).where(F.col("sector").isNotNull() & F.col("_label").isNotNull())
    per_contributor = (facts.groupBy("cycle", "sector", "_label", "contributor_id")
                       .agg(F.sum(amount_column(facts)).alias("_t")))
    labels = list(party_labels.values())
    wide = (per_contributor.groupBy("cycle", "sector").pivot("_label", labels)
            .agg(F.coalesce(F.sum("_t"), F.lit(0)).cast("long").alias("TotalAmountDonated"),
                 F.count(F.lit(1)).cast("long").alias("TotalContributorSize")))
    value_cols = [f"{lab}_{m}" for lab in labels for m in ("TotalAmountDonated", "TotalContributorSize")]
    return wide.select("cycle", "sector",
                       *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in value_cols])


def party_labels(tables: ContributionTables, empty_label: str = "NONE") -> dict[str, str]:
    """Pivot labels for every party code in the candidate and committee tables.

    '' (no party) gets ``empty_label``. Characters that are not letters, digits or
    '_' become '_' so labels are plain column names; codes that would share a label
    (column names ignore case) get numbered ones. More codes than
    ``spark.sql.pivotMaxValues`` are an error.
    """
    import re

    most = int(tables.candidates.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    parties = tables.candidates.select("party").unionByName(tables.committees.select("party"))
    codes = parties.select(F.coalesce("party", F.lit("")).alias("party")).distinct().limit(most + 1).collect()
    if len(codes) > most:
        raise ValueError(f"more than {most} party codes for a pivot (spark.sql.pivotMaxValues)")
    out: dict[str, str] = {}
    used: set[str] = set()
    for code in sorted(r["party"] for r in codes):
        plain = re.sub(r"[^0-9A-Za-z_]", "_", code) if code else empty_label
        label, n = plain, 1
        while label.lower() in used:
            n += 1
            label = f"{plain}_{n}"
        used.add(label.lower())
        out[code] = label
    return out
