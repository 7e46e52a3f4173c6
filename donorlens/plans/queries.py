"""Named queries over one test-data directory: (spark, sf_dir) -> DataFrame.

Each query loads the star tables of ``sf_dir``, maps them onto the
contribution tables (``donorlens.sources.star``) and runs one operator or
report over the whole tables.
"""

from __future__ import annotations

import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from donorlens.operators import basic, industry, parties
from donorlens.operators.segments import DEFAULT_MEASURES, Segment, largest_gift, sum_of_squares
from donorlens.plans import checks, reports, shared
from donorlens.schemas import TABLE_SCHEMAS
from donorlens.session import scratch_path
from donorlens.sinks import keyed
from donorlens.sources import load, snapshots
from donorlens.sources.files import FILE_RECORDS, read_csv_dir, read_parquet_dir, table_path, write_csv_dir
from donorlens.sources.star import load_star_tables
from donorlens.sources.tables import ContributionTables, normalise_tables

def tables_for(spark: SparkSession, sf_dir: str) -> ContributionTables:
    return normalise_tables(load_star_tables(spark, sf_dir))


def _q(fn: Callable[[ContributionTables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(tables_for(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the tables in the CSV extract layout, read them back, and sum the rows up per text value.

    Cities are given line breaks, blanks at both ends and quotes first. The files go to a
    fresh folder under the shared checkpoint directory.
    """
    folder = scratch_path(spark, f"csv-roundtrip-{uuid.uuid4().hex}")
    tables = tables_for(spark, sf_dir)
    city = ("CASE abs(amount) % 4 WHEN 0 THEN concat('New', char(10), city) WHEN 1 THEN concat(' ', city, ' ') "
            "WHEN 2 THEN concat('\"', city, '\", x') ELSE city END")
    write_csv_dir(tables.with_contributions(tables.contributions.withColumn("city", F.expr(city))), folder)
    back = read_csv_dir(spark, folder).contributions
    return back.groupBy("cycle", "city", "state", "zip", "gender").agg(
        F.count(F.lit(1)).alias("contributions"), F.sum("amount").alias("amount"),
        F.min("date").alias("first_date"), F.max("recipient_id").alias("last_recipient"))


def _load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load a CSV extract with bad values and short records and report what the load counted.

    By the amount: every fifth amount is no number, every third date no date, every seventh record
    lacks its last field.
    """
    folder = scratch_path(spark, f"rejects-{uuid.uuid4().hex}")
    tables = tables_for(spark, sf_dir)
    write_csv_dir(tables, folder, names=[name for name in TABLE_SCHEMAS if name != "individual_contributions"])
    lines = ("concat_ws(',', contributor_id, cycle, recipient_id, IF(abs(amount) % 3 = 0, 'some day', CAST(date AS STRING)), "
             "IF(abs(amount) % 5 = 0, 'n/a', CAST(amount AS STRING)), real_code, committee_id, other_id, gender, "
             "concat('\"', city, '\"'), state) || IF(abs(amount) % 7 = 0, '', ',' || zip)")
    tables.contributions.select(F.expr(lines).alias("value")).write.option("maxRecordsPerFile", FILE_RECORDS).text(
        table_path(folder, "individual_contributions"))
    loaded = load.store_loaded(load.raw_csv_dir(spark, folder), f"{folder}-loaded")
    return load.load_report(spark, loaded.counts)


def _snapshot_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extract, read again, change the source, see the copy refused, extract anew; (step, reused,
    refused, rows, amount) of the copy after each step."""
    folder = scratch_path(spark, f"snapshot-{uuid.uuid4().hex}")
    tables = tables_for(spark, sf_dir)
    source = f"{folder}/source"
    for name, df in tables.items():
        df.write.parquet(table_path(source, name, ".parquet"))
    steps = []

    def step(name: str) -> None:
        read = read_parquet_dir(spark, source)
        refused = False
        try:
            snapshots.open_snapshot(read, f"{folder}/copy")
        except snapshots.StaleSnapshotError:
            refused = True
        except FileNotFoundError:
            pass
        copy = snapshots.refresh_snapshot(read, f"{folder}/copy")
        counted = copy.rows["individual_contributions"]
        steps.append(copy.tables.contributions.agg(F.coalesce(F.sum("amount"), F.lit(0)).cast("long").alias("amount")).select(
            F.lit(name).alias("step"), F.lit(copy.reused).alias("reused"), F.lit(refused).alias("refused"),
            F.lit(counted).cast("long").alias("rows"), "amount"))

    step("extracted")
    step("read again")
    # refunds are added to the source
    tables.contributions.where("amount < 0").write.mode("append").parquet(table_path(source, "individual_contributions", ".parquet"))
    step("source changed")
    return steps[0].unionByName(steps[1]).unionByName(steps[2])


def _keyed_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the party report, rewrite its latest cycle from gifts of 10 and more, read it back."""
    path = scratch_path(spark, f"keyed-{uuid.uuid4().hex}")
    tables = tables_for(spark, sf_dir)
    keyed.replace_groups(reports.by_cycle_by_party(tables), path, ["cycle", "party"])
    latest = tables.contributions.agg(F.max("cycle")).first()[0]
    larger = tables.with_contributions(tables.contributions.where("amount >= 10"))
    again = reports.by_cycle_by_party(larger).where(F.col("cycle") == latest)
    return keyed.replace_groups(again, path, ["cycle", "party"])


def _key_violations(t: ContributionTables) -> DataFrame:
    """Keys one might take for unique in the inputs, and how many of their values repeat."""
    return checks.key_violation_summary({
        "candidates": (t.candidates, ["cid"]),
        "candidates per cycle": (t.candidates, ["cid", "cycle"]),
        "committees": (t.committees, ["committee_id"]),
        "industry_codes": (t.industry_codes, ["category_code"]),
        "contributions": (t.contributions, ["contributor_id", "date", "recipient_id"]),
    })


def _all_reports(t: ContributionTables) -> DataFrame:
    """The six reports from one stored, folded copy of the contributions, in long form."""
    return shared.long_form(shared.all_reports(shared.store(shared.fold(t))))


def _custom_measures(t: ContributionTables) -> DataFrame:
    """By party and cycle: largest gift, sum of squares and total, over three custom segments."""
    segments = [Segment("", "all"), Segment("Refund", "row", "amount < 0"), Segment("Repeat", "contributor", "cycle > first_cycle")]
    return reports.by_cycle_by_party(t, segments=segments, measures=[DEFAULT_MEASURES[0], largest_gift(), sum_of_squares()])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # building blocks
    "distinct_cycles": _q(lambda t: basic.distinct_values(t.contributions, "cycle")),
    "recipient_kinds": _q(lambda t: basic.recipient_kinds(t.contributions)),
    "parties_per_cycle": _q(parties.parties_per_cycle),
    "contributions_by_party": _q(parties.contributions_by_party),
    "gender_contributions": _q(lambda t: basic.gender_contributions(t.contributions)),
    "contributor_first_cycle": _q(lambda t: basic.contributor_first_cycle(t.contributions)),
    "first_time_contributions": _q(lambda t: basic.first_time_contributions(t.contributions)),
    "contributor_cycle_totals": _q(lambda t: basic.contributor_cycle_totals(t.contributions)),
    "small_contributions": _q(lambda t: basic.contributions_by_size(t.contributions, large=False)),
    "large_contributions": _q(lambda t: basic.contributions_by_size(t.contributions, large=True)),
    "measures_overall": _q(lambda t: basic.overall_measures(t.contributions)),
    "duplicate_contributions": _q(lambda t: basic.duplicate_contributions(t.contributions)),
    # reports
    "report_by_cycle": _q(lambda t: reports.by_cycle(t)),
    "report_by_cycle_as_coded": _q(lambda t: reports.by_cycle(t, mode="as_coded")),
    "report_by_cycle_by_party": _q(lambda t: reports.by_cycle_by_party(t)),
    "report_by_cycle_by_party_as_coded": _q(lambda t: reports.by_cycle_by_party(t, mode="as_coded")),
    "report_top_candidates": _q(lambda t: reports.top_candidates(t)),
    "report_top_committees": _q(lambda t: reports.top_committees(t)),
    "report_top_committees_pass_through": _q(lambda t: reports.top_committees(t, attribution="pass_through")),
    "report_by_sector": _q(lambda t: reports.by_sector(t)),
    "report_by_sector_keep_unmatched": _q(lambda t: reports.by_sector(t, keep_unmatched=True)),
    "report_by_sector_by_party": _q(lambda t: reports.by_sector_by_party(t)),
    "report_sector_totals_and_parties": _q(lambda t: reports.sector_totals_and_parties(t)),
    "report_custom_measures": _q(_custom_measures),
    # folded and stored contributions
    "all_reports": _q(_all_reports),
    "report_by_cycle_by_party_folded": _q(lambda t: reports.by_cycle_by_party(
        shared.fold(t, ["contributor_id", "cycle", "recipient_id"]))),
    "report_by_sector_by_party_folded": _q(lambda t: reports.by_sector_by_party(
        shared.fold(t, ["contributor_id", "cycle", "recipient_id", "real_code"]))),
    "report_by_cycle_bucketed": _q(lambda t: reports.by_cycle(shared.store(shared.fold(t), buckets=8))),
    "report_by_sector_pivot": _q(lambda t: reports.by_sector_pivot(t, industry.party_labels(t))),
    # quality
    "unmatched_recipients": _q(parties.unmatched_recipients),
    "key_violations": _q(_key_violations),
    "dimension_conflicts": _q(checks.dimension_conflicts),
    "load_profile": _q(checks.load_profile),
    "lenient_dates": _q(lambda t: basic.date_parse_profile(t.contributions)),
    # sources and sinks
    "csv_roundtrip": _csv_roundtrip,
    "load_rejects": _load_rejects,
    "snapshot_refresh": _snapshot_refresh,
    "keyed_replace": _keyed_replace,
}
