"""Other formulations of the same reports, for differential tests and the benchmark.

* ``flat_report``: windows over raw contributions plus one ``count(distinct)``
  per segment. Correct, but a window partition holds all rows of one
  contributor (a hot contributor lands in one task) and six distinct
  aggregates compile to an Expand with an extra shuffle.
* ``loop_report_by_cycle``: the original job's shape — the driver loops over
  cycles and runs one Spark job per statistic (1 + 18 x cycles jobs).

Neither is used by the library; they exist to be compared against it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SEGMENT_SQL = [("", None), ("Female", "gender = 'F'"), ("Male", "gender = 'M'"),
               ("FirstTime", "cycle = first_cycle"), ("Small", "cycle_total < 100"),
               ("Large", "cycle_total > 2000")]


def flat_stats(f: DataFrame, keys: list[str], segments=SEGMENT_SQL) -> DataFrame:
    aggs = []
    for label, pred in segments:
        p = F.lit(True) if pred is None else F.expr(pred)
        aggs += [F.coalesce(F.sum(F.when(p, F.col("amount"))), F.lit(0)).cast("long")
                 .alias(f"Total{label}AmountDonated"),
                 F.count_distinct(F.when(p, F.col("contributor_id"))).cast("long")
                 .alias(f"Total{label}ContributorSize"),
                 F.coalesce(F.bround(F.avg(F.when(p, F.col("amount"))), 0), F.lit(0)).cast("long")
                 .alias(f"Average{label}AmountDonated")]
    return f.groupBy(*keys).agg(*aggs)


def with_contributor_windows(facts: DataFrame) -> DataFrame:
    return (facts.withColumn("first_cycle", F.min("cycle").over(Window.partitionBy("contributor_id")))
            .withColumn("cycle_total", F.sum("amount").over(Window.partitionBy("contributor_id", "cycle"))))


def flat_report(facts: DataFrame, keys: list[str], keep: str | None = None) -> DataFrame:
    """Spec-mode report in the flat form; ``keep`` filters rows after the windows."""
    f = with_contributor_windows(facts)
    if keep:
        f = f.where(keep)
    return flat_stats(f, keys)


def loop_report_by_cycle(facts: DataFrame) -> list[tuple]:
    """as_coded by-cycle report computed the original way, one job per statistic."""
    out = []
    for (cycle,) in facts.select("cycle").distinct().collect():
        part = facts.where(F.col("cycle") == cycle)
        totals = part.groupBy("contributor_id", "cycle").agg(F.sum("amount").alias("tot"))
        segs = {"": part, "Female": part.where("gender = 'F'"), "Male": part.where("gender = 'M'"),
                "FirstTime": part,
                "Small": part.join(totals.where("tot < 100"), ["contributor_id", "cycle"], "left_semi"),
                "Large": part.join(totals.where("tot > 2000"), ["contributor_id", "cycle"], "left_semi")}
        row = [cycle]
        for label, _ in SEGMENT_SQL:
            s = segs[label]
            total = s.agg(F.sum("amount")).first()[0] or 0
            size = s.select("contributor_id").distinct().count()
            avg = s.agg(F.avg("amount")).first()[0]
            row += [total, size, round(avg) if avg is not None else 0]
        out.append(tuple(row))
    return out


__all__ = ["flat_report", "flat_stats", "loop_report_by_cycle", "with_contributor_windows"]
