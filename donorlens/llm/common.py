"""Helpers shared by the text operators: input tables and staged intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

# The contract's white space: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD_BREAK = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text) -> "F.Column":
    """Words of a text column as an array; a null text has none."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_BREAK)
    return F.array_remove(parts, "")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; only a session that names none
    (a local test session) gets a scratch folder of its own, and keeps it in that setting."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            base = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A Spark SQL setting for the actions inside."""
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def batches_of(spark: SparkSession, rows: int):
    """Rows of whole texts are large: fewer of them cross to Python at a time."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def stage(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, so a lost
    executor costs a re-read, and several consumers share one computation. ``options`` go to the writer.
    The shuffle files behind it are not needed any more and go with the write."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*staged: DataFrame) -> None:
    """Deletes the files of staged tables that nothing reads any more."""
    for df in staged:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def exactly(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, each resolved once: extra columns with any name do not matter."""
    return df.select(*[df[n] for n in names])


def by_value(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.Table]:
    """In a task: the sorted rows, one table per value of a column."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        value = batch.column(column).to_numpy()
        cuts = [0, *((value[1:] != value[:-1]).nonzero()[0] + 1).tolist(), len(value)]
        for a, b in zip(cuts, cuts[1:]):
            if held and a < b and held[-1].column(column)[0].as_py() != value[a]:
                yield pa.Table.from_batches(held)
                held = []
            if a < b:
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def by_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """In a task: the rows, about ``rows`` at a time."""
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)
