"""Load with counts: every table is written once, and that write tells what it rejected.

``store_loaded`` types raw tables, writes them to a folder and observes the rows on their way
(``DataFrame.observe``): row counts, malformed records and, per typed column, the values that
became NULL. No second scan of the source. ``load_report`` turns the counts into a table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from donorlens.schemas import TABLE_SCHEMAS
from donorlens.sources.files import BAD_RECORD, read_csv_table, table_path
from donorlens.sources.tables import ContributionTables, normalise, reject_aggregates


@dataclass(frozen=True)
class Loaded:
    """Stored, typed tables and the counts of the load: table name to {metric: value}."""

    tables: ContributionTables
    counts: dict[str, dict[str, int]]


def raw_csv_dir(spark: SparkSession, directory: str, suffix: str = ".csv", *, multiline: bool = True) -> ContributionTables:
    """The extract's tables as text columns, with ``BAD_RECORD`` for records of a wrong width."""
    return ContributionTables(**{
        name: read_csv_table(spark, table_path(directory, name, suffix), schema, multiline=multiline, bad_records=True)
        for name, schema in TABLE_SCHEMAS.items()})


def raw_parquet_dir(spark: SparkSession, directory: str) -> ContributionTables:
    """``directory/<table>.parquet`` as stored."""
    return ContributionTables(**{name: spark.read.parquet(table_path(directory, name, ".parquet")) for name in TABLE_SCHEMAS})


def store_loaded(raw: ContributionTables, folder: str, *, strict: bool = False) -> Loaded:
    """Write the typed tables to ``folder/<table>.parquet``, counting on the way, and read them back.

    ``strict`` fails the write at the first value or record that the lenient load would reject.
    """
    spark = raw.contributions.sparkSession
    stored, counts = {}, {}
    for name, df in raw.items():
        schema = TABLE_SCHEMAS[name]
        metrics = [F.count(F.lit(1)).alias("rows"), *reject_aggregates(df, schema)]
        if BAD_RECORD in df.columns:
            metrics.append(F.count(BAD_RECORD).alias("record_rejects"))
        seen = Observation()
        rows = df.observe(seen, *metrics)
        if strict and BAD_RECORD in df.columns:
            message = F.concat(F.lit(f"malformed record of {name}: "), F.col(BAD_RECORD))
            rows = rows.where(F.when(F.col(BAD_RECORD).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
        path = table_path(folder, name, ".parquet")
        normalise(rows, schema, strict=strict).write.parquet(path)
        counts[name] = {k: int(v) for k, v in seen.get.items()}
        stored[name] = spark.read.schema(schema).parquet(path)
    return Loaded(ContributionTables(**stored), counts)


def load_report(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """(table_name, metric, value): the counts of a load, one row each."""
    rows = [(table, metric, value) for table, metrics in counts.items() for metric, value in metrics.items()]
    return spark.createDataFrame(rows, "table_name string, metric string, value long")
