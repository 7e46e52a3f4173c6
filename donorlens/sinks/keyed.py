"""Keyed replacement of a report on files: a rerun replaces only the groups it computed.

A report is stored as Parquet partitioned by one of its key columns (the cycle). ``replace_groups``
stages the new rows, checks their keys on the staged copy and only then swaps the partitions they
hold (Spark's dynamic partition overwrite): a failed check leaves the old report, other
cycles are not touched, and no row is computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from donorlens.sinks.writers import check_unique, store


class MixedSchemaError(ValueError):
    """The stored report has other columns or types than the new rows."""


def read_report(spark: SparkSession, path: str, schema) -> DataFrame:
    """The stored report in the column order of ``schema``."""
    return spark.read.schema(schema).parquet(path).select(*[f"`{f.name}`" for f in schema.fields])


def _stored_columns(spark: SparkSession, path: str) -> dict[str, str] | None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None
    return dict(spark.read.parquet(path).dtypes)


def replace_groups(report: DataFrame, path: str, keys: list[str], *, by: str = "cycle") -> DataFrame:
    """Replace the partitions of ``path`` whose ``by`` value is in ``report``; return the whole stored report.

    Raises ``DuplicateKeyError`` if a key repeats, ``MixedSchemaError`` if the stored report has other
    columns, and ``ValueError`` if ``by`` is not a key or NULL somewhere; the stored report is then unchanged.
    """
    if by not in keys:
        raise ValueError(f"{by!r} must be one of the keys {keys}")
    spark = report.sparkSession
    before = _stored_columns(spark, path)
    if before is not None:
        new = dict(report.dtypes)
        if bad := sorted(c for c in {*before, *new} if before.get(c) != new.get(c) and not (c == by and c in before and c in new)):
            raise MixedSchemaError(f"stored report in {path} differs in {bad}")
    staged = store(report)
    if not staged.where(F.col(by).isNull()).isEmpty():
        raise ValueError(f"NULL in {by!r}: its rows would have no partition to replace")
    check_unique(staged, keys)
    # one file per group: reports have few rows per cycle
    (staged.repartition(by).sortWithinPartitions(*keys).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))
    return read_report(spark, path, report.schema)
