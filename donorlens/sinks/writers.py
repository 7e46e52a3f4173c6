"""Report sinks: database tables over JDBC and flat files.

Reports are small (one row per group), but they are written by executors,
never collected to the driver. Before a write the report key is checked for
uniqueness (the database primary key of the original job; Spark has none).
A report is computed once: it is stored under the shared checkpoint folder, and
the key check and every sink read the stored rows.
"""

from __future__ import annotations

import uuid
from typing import Iterable

from pyspark.sql import DataFrame, types as T

from donorlens.plans.checks import key_violations
from donorlens.session import scratch_path


class DuplicateKeyError(ValueError):
    pass


def store(report: DataFrame) -> DataFrame:
    """Compute ``report`` once: write it to a fresh folder of the shared storage and read that."""
    path = scratch_path(report.sparkSession, f"report-{uuid.uuid4().hex}")
    report.write.parquet(path)
    return report.sparkSession.read.schema(report.schema).parquet(path)


def check_unique(report: DataFrame, keys: list[str]) -> None:
    """Raise if any key value occurs twice (one small action)."""
    dup = key_violations(report, keys).limit(1).collect()
    if dup:
        raise DuplicateKeyError(f"duplicate report key {keys}: {dup[0].asDict()}")


def column_types(report: DataFrame) -> str:
    """JDBC column DDL: integer keys and bigint statistics. Text columns are left to the
    database dialect's own unbounded text type; any other type is an error."""
    ddl = []
    for f in report.schema.fields:
        if isinstance(f.dataType, T.IntegerType):
            ddl.append(f"{f.name} INTEGER")
        elif isinstance(f.dataType, T.LongType):
            ddl.append(f"{f.name} BIGINT")
        elif not isinstance(f.dataType, T.StringType):
            raise TypeError(f"no column type for {f.name}: {f.dataType.simpleString()}")
    return ", ".join(ddl)


def write_jdbc(report: DataFrame, url: str, table: str, properties: dict, *, keys: list[str] | None = None,
               mode: str = "overwrite", batch_size: int = 10000, num_partitions: int = 8,
               stored: bool = False) -> None:
    """Replace ``table`` with the report (typed columns, batched inserts). ``stored`` says that
    ``report`` already reads stored rows."""
    types = column_types(report)
    if keys:
        report = report if stored else store(report)
        check_unique(report, keys)
    writer = (report.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
              .option("createTableColumnTypes", types)
              .option("batchsize", str(batch_size)).option("numPartitions", str(num_partitions)))
    for key, value in properties.items():
        writer = writer.option(key, value)
    writer.save()


def write_files(report: DataFrame, path: str, *, fmt: str = "csv", keys: list[str] | None = None,
                mode: str = "overwrite", single_file: bool = True, stored: bool = False) -> None:
    """Flat-file export. ``single_file`` merges the stored rows of the (small) report into one
    part file, ordered by the key columns (a sort inside that one partition, no shuffle).
    ``stored`` says that ``report`` already reads stored rows."""
    if (keys or single_file) and not stored:
        report = store(report)
    if keys:
        check_unique(report, keys)
    out = report.coalesce(1) if single_file else report
    if single_file and keys:
        out = out.sortWithinPartitions(*keys)
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true")
    writer.save(path)


def run_reports(reports: Iterable[tuple[str, DataFrame]], sink, *, keys: dict[str, list[str]] | None = None):
    """Store every ``(name, report)`` and write it with ``sink(report, name, keys)``; return the names written."""
    written = []
    for name, report in reports:
        sink(store(report), name, (keys or {}).get(name))
        written.append(name)
    return written
