"""Building-block operators over the contributions table.

Each returns a lazy DataFrame. Per-contributor facts are plain aggregations
(map-side combined, so a hot contributor id costs one row per task); rows are
selected with semi joins against those aggregates rather than windows over
raw rows, which would put a hot contributor's rows into one task. AQE splits
a skewed semi-join partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from donorlens.functions.expressions import half_even_ratio, recipient_kind, zero_if_null
from donorlens.schemas import CONTRIBUTION_COLUMNS, LARGE_ABOVE, SMALL_BELOW


def dealt_out(df: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows in tasks of the session's advisory size, for an aggregate by nearly unique ``keys``.

    Its map-side table would otherwise be built where the rows are made, beside the sorts of a join, over
    narrow input that grows many times on the way. Equal keys of one source task stay together, those of
    different tasks are spread, so a hot key is still combined before the aggregate's own shuffle.
    """
    return df.repartition(*keys, F.spark_partition_id())


def distinct_values(df: DataFrame, column: str, sort: bool = False) -> DataFrame:
    out = df.select(column).distinct()
    return out.orderBy(column) if sort else out


def gender_filter(df: DataFrame, gender: str) -> DataFrame:
    return df.where(F.col("gender") == F.lit(gender))


def contributor_first_cycle(df: DataFrame) -> DataFrame:
    """(contributor_id, first_cycle): earliest cycle of every contributor."""
    return df.groupBy("contributor_id").agg(F.min("cycle").alias("first_cycle"))


def first_time_contributions(df: DataFrame) -> DataFrame:
    """Contributions made in the contributor's first cycle."""
    first = contributor_first_cycle(df).withColumnRenamed("first_cycle", "cycle")
    return df.join(first, ["contributor_id", "cycle"], "left_semi").select(*df.columns)


def contributor_cycle_totals(df: DataFrame) -> DataFrame:
    """(contributor_id, cycle, total_amount): a contributor's total in a cycle."""
    return df.groupBy("contributor_id", "cycle").agg(F.sum("amount").alias("total_amount"))


def contributions_by_size(df: DataFrame, *, large: bool,
                          small_below: int = SMALL_BELOW, large_above: int = LARGE_ABOVE) -> DataFrame:
    """Contributions of contributors whose cycle total is < small_below (or > large_above)."""
    totals = contributor_cycle_totals(df)
    band = F.col("total_amount") > large_above if large else F.col("total_amount") < small_below
    # The join gets an exchange of its own on both sides: over the aggregate's own partitioning
    # adaptive execution would not split a hot contributor's rows.
    keys = totals.where(band).select("contributor_id", "cycle").repartition(F.xxhash64("cycle", "contributor_id"))
    return df.join(keys, ["contributor_id", "cycle"], "left_semi").select(*df.columns)


def overall_measures(df: DataFrame) -> DataFrame:
    """Total, distinct contributors and row-mean (half-even) over a whole table."""
    per_contributor = df.groupBy("contributor_id").agg(F.sum("amount").alias("_t"),
                                                       F.count("amount").alias("_n"))
    return per_contributor.agg(
        zero_if_null(F.sum("_t")).alias("TotalAmountDonated"),
        F.count(F.lit(1)).cast("long").alias("TotalContributorSize"),
        half_even_ratio(F.sum("_t"), F.sum("_n")).alias("AverageAmountDonated"),
    )


def recipient_kinds(df: DataFrame) -> DataFrame:
    """(recipient_kind, contributions, recipients, amount) by id prefix."""
    per_recipient = (df.groupBy("recipient_id")
                     .agg(F.count(F.lit(1)).alias("_rows"), F.sum("amount").alias("_amt")))
    return (per_recipient.groupBy(recipient_kind("recipient_id").alias("recipient_kind"))
            .agg(F.sum("_rows").cast("long").alias("contributions"),
                 F.count(F.lit(1)).cast("long").alias("recipients"),
                 zero_if_null(F.sum("_amt")).alias("amount")))


def gender_contributions(df: DataFrame) -> DataFrame:
    """(cycle, gender, contributions, contributors, amount)."""
    per_contributor = (df.groupBy("cycle", "gender", "contributor_id")
                       .agg(F.count(F.lit(1)).alias("_rows"), F.sum("amount").alias("_amt")))
    return (per_contributor.groupBy("cycle", "gender")
            .agg(F.sum("_rows").cast("long").alias("contributions"),
                 F.count(F.lit(1)).cast("long").alias("contributors"),
                 zero_if_null(F.sum("_amt")).alias("amount")))


def duplicate_contributions(df: DataFrame) -> DataFrame:
    """Identical contribution rows: (cycle, duplicated_rows, extra_copies)."""
    rows = dealt_out(df.select(*CONTRIBUTION_COLUMNS), CONTRIBUTION_COLUMNS)
    copies = rows.groupBy(*CONTRIBUTION_COLUMNS).agg(F.count(F.lit(1)).alias("_copies"))
    return (copies.where(F.col("_copies") > 1).groupBy("cycle")
            .agg(F.count(F.lit(1)).cast("long").alias("duplicated_rows"),
                 F.sum(F.col("_copies") - 1).cast("long").alias("extra_copies")))


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows (a sample for display; the limit is the feature)."""
    return df.limit(n)


def cycle_filter(df: DataFrame, cycle: int) -> DataFrame:
    return df.where(F.col("cycle") == F.lit(cycle))


def party_filter(df: DataFrame, party: str) -> DataFrame:
    """Rows of one party; a literal comparison, so any party text is safe."""
    return df.where(F.col("party") == F.lit(party))


def date_parse_profile(df: DataFrame) -> DataFrame:
    """Lenient date parsing over the contributions, per cycle.

    Each contribution date is rendered as text in one of three shapes,
    chosen by ``abs(amount) % 3``: the source timestamp format, a bare date,
    or an unparseable slash form. The text is parsed back with the loader's
    lenient rule. (cycle, parsed, failed, mismatched): mismatched counts parsed
    dates that differ from the original and must be 0.
    """
    from donorlens.functions.expressions import lenient_date

    shape = F.abs(F.col("amount")) % 3
    text = (F.when(shape == 0, F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
            .when(shape == 1, F.date_format("date", "yyyy-MM-dd"))
            .otherwise(F.date_format("date", "yyyy/MM/dd")))
    parsed = df.select("cycle", "date", lenient_date(text).alias("_parsed"))
    return parsed.groupBy("cycle").agg(
        F.count("_parsed").cast("long").alias("parsed"),
        F.count(F.when(F.col("_parsed").isNull(), 1)).cast("long").alias("failed"),
        F.count(F.when(F.col("_parsed") != F.col("date"), 1)).cast("long").alias("mismatched"),
    )
