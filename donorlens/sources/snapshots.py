"""Snapshots with identity: a copy is reused only if it is of this source and this schema.

A snapshot folder holds versions (one folder per extract with all four tables) and a small JSON
pointer ``current.json`` that names the published version, its source, schemas and row counts. The
pointer is written aside and renamed after all tables are complete, so readers see either the old
version whole or the new one; an extract that fails leaves the old pointer in place.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from donorlens.schemas import TABLE_SCHEMAS
from donorlens.sources.files import table_path
from donorlens.sources.tables import ContributionTables

POINTER = "current.json"


@dataclass(frozen=True)
class Snapshot:
    tables: ContributionTables
    version: str
    reused: bool
    rows: dict[str, int]


class StaleSnapshotError(ValueError):
    """The published copy is of another source or schema."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def source_fingerprint(tables: ContributionTables) -> str:
    """A digest of the files the tables read: paths, lengths and modification times. Tables that
    read no files (a database) have no fingerprint of their own: name the source instead."""
    spark = tables.contributions.sparkSession
    parts = []
    for name, df in tables.items():
        files = sorted(df.inputFiles())
        if not files:
            raise ValueError(f"{name} reads no files: pass source=, e.g. the database and its load date")
        for file in files:
            fs, path = _fs(spark, file)
            status = fs.getFileStatus(path)
            parts.append(f"{name} {file} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


def schema_of(tables: ContributionTables) -> dict[str, str]:
    return {name: df.schema.json() for name, df in tables.items()}


def read_pointer(spark: SparkSession, directory: str) -> dict | None:
    """The published version's manifest, or None."""
    fs, path = _fs(spark, posixpath.join(directory, POINTER))
    if not fs.exists(path):
        return None
    text = spark.read.option("wholetext", "true").text(posixpath.join(directory, POINTER)).first()
    return json.loads(text[0])


def _publish(spark: SparkSession, directory: str, manifest: dict) -> None:
    fs, aside = _fs(spark, posixpath.join(directory, f"_{POINTER}-{uuid.uuid4().hex}"))
    out = fs.create(aside, True)
    out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
    out.close()
    pointer = _fs(spark, posixpath.join(directory, POINTER))[1]
    # one call that replaces the pointer where the file system can, e.g. HDFS and local files
    jvm = spark.sparkContext._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(aside, pointer, options)


def _read(spark: SparkSession, directory: str, manifest: dict, reused: bool) -> Snapshot:
    folder = posixpath.join(directory, manifest["version"])
    tables = ContributionTables(**{
        name: spark.read.schema(TABLE_SCHEMAS[name]).parquet(table_path(folder, name, ".parquet")) for name in TABLE_SCHEMAS})
    return Snapshot(tables, manifest["version"], reused, manifest["rows"])


def open_snapshot(tables: ContributionTables, directory: str, *, source: str | None = None) -> Snapshot:
    """The published copy of ``tables``; raises ``StaleSnapshotError`` if it is of another source or schema."""
    spark = tables.contributions.sparkSession
    manifest = read_pointer(spark, directory)
    if manifest is None:
        raise FileNotFoundError(f"no snapshot in {directory}")
    wanted = {"source": source or source_fingerprint(tables), "schemas": schema_of(tables)}
    if bad := [k for k, v in wanted.items() if manifest[k] != v]:
        raise StaleSnapshotError(f"the copy in {directory} has another {' and '.join(bad)}")
    return _read(spark, directory, manifest, True)


def refresh_snapshot(tables: ContributionTables, directory: str, *, source: str | None = None) -> Snapshot:
    """The published copy of ``tables`` if it is current; else extract all four anew and publish them.

    Older versions stay, for readers that still hold them.
    """
    spark = tables.contributions.sparkSession
    source = source or source_fingerprint(tables)
    try:
        return open_snapshot(tables, directory, source=source)
    except (FileNotFoundError, StaleSnapshotError):
        pass
    version = f"v-{uuid.uuid4().hex}"
    rows = {}
    for name, df in tables.items():
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(
            table_path(posixpath.join(directory, version), name, ".parquet"))
        rows[name] = int(seen.get["rows"])
    manifest = {"version": version, "source": source, "schemas": schema_of(tables), "rows": rows}
    _publish(spark, directory, manifest)
    return _read(spark, directory, manifest, False)


def row_counts(snapshot: Snapshot) -> DataFrame:
    """(table_name, rows) as the extract counted them."""
    spark = snapshot.tables.contributions.sparkSession
    return spark.createDataFrame(sorted(snapshot.rows.items()), "table_name string, rows long")
