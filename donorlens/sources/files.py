"""File sources: a directory of CSV extracts, and Parquet snapshots.

The CSV layout is the relational extract format: one file (or folder of
part files) per table, comma separated, '"' quoting, no header, fixed column
order, leading blanks after a delimiter ignored, SQL NULL written as an empty
field. Every column is read as text and typed by ``normalise``, so a bad
integer or date becomes NULL and is counted by ``rejects`` instead of failing
the job. A quoted field may hold line breaks; an extract known to have one
record per line is read in splits with ``multiline=False``. A record with a wrong
number of fields is kept, padded or cut to the columns, counted by
``csv_rejects`` and refused by a strict load.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from donorlens.schemas import TABLE_SCHEMAS
from donorlens.sources.tables import ContributionTables, normalise, rejects


def _text_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


# Holds a record whose number of fields is wrong, whole; NULL otherwise.
BAD_RECORD = "_bad_record"

FILE_RECORDS = 400_000


def read_csv_table(spark: SparkSession, path: str, schema: T.StructType, *, multiline: bool = True,
                   bad_records: bool = False) -> DataFrame:
    """Raw text columns of one extract file (or folder); ``bad_records`` adds ``BAD_RECORD``."""
    text = _text_schema(schema)
    if bad_records:
        text = T.StructType([*text.fields, T.StructField(BAD_RECORD, T.StringType(), True)])
    return (spark.read.schema(text)
            .option("multiLine", str(multiline).lower())
            .option("columnNameOfCorruptRecord", BAD_RECORD)
            # fields can only be counted where none is pruned
            .option("columnPruning", str(not bad_records).lower())
            .option("header", "false")
            .option("sep", ",")
            .option("quote", '"')
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", "true")
            .option("mode", "PERMISSIVE")
            .csv(path))


def table_path(directory: str, name: str, suffix: str = ".csv") -> str:
    return posixpath.join(directory.rstrip("/"), f"{name}{suffix}")


def read_csv_dir(spark: SparkSession, directory: str, suffix: str = ".csv", *,
                 strict: bool = False, multiline: bool = True) -> ContributionTables:
    """The four tables from ``directory/<table><suffix>``, typed and normalised.

    ``strict=True`` fails on a malformed integer or date instead of NULLing it,
    and on a record with a wrong number of fields.
    """
    out = {}
    for name, schema in TABLE_SCHEMAS.items():
        raw = read_csv_table(spark, table_path(directory, name, suffix), schema, multiline=multiline, bad_records=strict)
        if strict:
            message = F.concat(F.lit(f"malformed record of {name}: "), F.col(BAD_RECORD))
            raw = raw.where(F.when(F.col(BAD_RECORD).isNotNull(), F.raise_error(message).cast("boolean"))
                            .otherwise(F.lit(True)))
        out[name] = normalise(raw, schema, strict=strict)
    return ContributionTables(**out)


def csv_rejects(spark: SparkSession, directory: str, suffix: str = ".csv", *,
                multiline: bool = True) -> dict[str, DataFrame]:
    """Per table, one row counting values that failed to parse (NULLed on load) and
    ``record_rejects``, the records with a wrong number of fields."""
    out = {}
    for name, schema in TABLE_SCHEMAS.items():
        raw = read_csv_table(spark, table_path(directory, name, suffix), schema, multiline=multiline, bad_records=True)
        out[name] = rejects(raw, schema, F.count(BAD_RECORD).alias("record_rejects"))
    return out


def write_csv_dir(tables: ContributionTables, directory: str, suffix: str = ".csv",
                  mode: str = "overwrite", names: list[str] | None = None) -> None:
    """Write the tables (or those in ``names``) in the extract layout (folders of part files, no header).

    Every field is quoted, so that blanks at its ends survive the reader. A file with quoted line
    breaks is read whole by one task, so no file holds more than ``FILE_RECORDS`` records.
    """
    for name, df in tables.items():
        if names is not None and name not in names:
            continue
        (df.write.mode(mode).option("header", "false").option("quote", '"').option("escape", '"')
         .option("quoteAll", "true").option("ignoreLeadingWhiteSpace", "false")
         .option("ignoreTrailingWhiteSpace", "false").option("emptyValue", "")
         .option("maxRecordsPerFile", FILE_RECORDS).csv(table_path(directory, name, suffix)))


def _is_complete(spark: SparkSession, path: str) -> bool:
    """True when a finished Spark write left its ``_SUCCESS`` marker at ``path``."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(posixpath.join(path, "_SUCCESS"))
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def snapshot(tables: ContributionTables, directory: str) -> ContributionTables:
    """Extract once: write each table as Parquet unless a complete copy is there, then read it back.

    A copy counts only if its write finished (``_SUCCESS`` marker); a folder
    left by a failed or interrupted write is overwritten, never read.
    """
    spark = tables.contributions.sparkSession
    out = {}
    for name, df in tables.items():
        path = table_path(directory, name, ".parquet")
        if not _is_complete(spark, path):
            df.write.mode("overwrite").parquet(path)
        out[name] = spark.read.schema(TABLE_SCHEMAS[name]).parquet(path)
    return ContributionTables(**out)


def read_parquet_dir(spark: SparkSession, directory: str, *, strict: bool = False) -> ContributionTables:
    """Tables stored as ``directory/<table>.parquet``, typed and normalised (``strict`` as for CSV)."""
    return ContributionTables(**{
        name: normalise(spark.read.parquet(table_path(directory, name, ".parquet")), schema, strict=strict)
        for name, schema in TABLE_SCHEMAS.items()
    })
