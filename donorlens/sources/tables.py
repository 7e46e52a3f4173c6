"""The four contribution tables as one value, plus load-time normalisation."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F, types as T

from donorlens.functions.expressions import lenient_date, lenient_int
from donorlens.schemas import TABLE_SCHEMAS


@dataclass(frozen=True)
class ContributionTables:
    """Named registry of the input tables; every field is a lazy DataFrame."""

    candidates: DataFrame
    committees: DataFrame
    industry_codes: DataFrame
    individual_contributions: DataFrame

    @property
    def contributions(self) -> DataFrame:
        return self.individual_contributions

    def items(self):
        return [(name, getattr(self, name)) for name in TABLE_SCHEMAS]

    def map(self, fn) -> "ContributionTables":
        """Apply ``fn(name, df)`` to every table."""
        return ContributionTables(**{name: fn(name, df) for name, df in self.items()})

    def with_contributions(self, df: DataFrame) -> "ContributionTables":
        return replace(self, individual_contributions=df)

    def sample(self, n: int | None) -> "ContributionTables":
        """Development sample: only the first ``n`` contributions (off when None)."""
        if n is None:
            return self
        return self.with_contributions(self.individual_contributions.limit(n))


def normalise(df: DataFrame, schema: T.StructType, *, strict: bool = False) -> DataFrame:
    """Bring a raw table to its fixed schema.

    Strings: NULL becomes '' (the extract writes NULL as an empty field).
    Integers and dates are parsed leniently: a text that does not parse, and a
    number that an integer column cannot hold unchanged, become NULL instead of
    failing the job; ``rejects`` counts them. With ``strict=True`` such a value,
    or an empty text for an integer, fails the job even where no report reads its column.
    """
    cols, checks = [], []
    for field in schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            cols.append(F.coalesce(c.cast("string"), F.lit("")).alias(field.name))
            continue
        source = df.schema[field.name].dataType
        value = _typed(c, source, field.dataType)
        cols.append(value.alias(field.name))
        bad = _rejected(c, source, value)
        if isinstance(source, T.StringType) and isinstance(field.dataType, T.IntegerType):
            bad = value.isNull()
        shown = F.concat(F.lit(f"unparseable {field.name}: "), F.coalesce(c.cast("string"), F.lit("")))
        checks.append((bad, shown))
    if strict and checks:
        # a filter, so that no column pruning removes a check
        (bad, shown), *more = checks
        fine = F.when(bad, F.raise_error(shown).cast("boolean"))
        for bad, shown in more:
            fine = fine.when(bad, F.raise_error(shown).cast("boolean"))
        df = df.where(fine.otherwise(F.lit(True)))
    return df.select(*cols)


def _typed(c, source: T.DataType, target: T.DataType):
    """The value of a raw column in its fixed type; NULL where it has none."""
    if isinstance(source, T.StringType) and isinstance(target, T.IntegerType):
        return lenient_int(c)
    if isinstance(source, T.StringType) and isinstance(target, T.DateType):
        return lenient_date(c)
    if isinstance(source, T.NumericType) and source != target:
        whole = c.try_cast(target)
        return F.when(whole == c, whole)
    return c.cast(target)


def _rejected(c, source: T.DataType, value):
    """Is there a raw value that has no typed one? Blank text counts as no value."""
    given = c.isNotNull() & (F.trim(c) != "") if isinstance(source, T.StringType) else c.isNotNull()
    return given & value.isNull()


def normalise_tables(tables: ContributionTables, *, strict: bool = False) -> ContributionTables:
    return tables.map(lambda name, df: normalise(df, TABLE_SCHEMAS[name], strict=strict))


def reject_aggregates(raw: DataFrame, schema: T.StructType) -> list:
    """Per typed column, the count of non-empty raw values that the load turns into NULL."""
    aggs = []
    for field in schema.fields:
        source = raw.schema[field.name].dataType
        if not isinstance(field.dataType, T.StringType) and source != field.dataType:
            c = F.col(field.name)
            bad = _rejected(c, source, _typed(c, source, field.dataType))
            aggs.append(F.count(F.when(bad, 1)).alias(f"{field.name}_rejects"))
    return aggs


def rejects(raw: DataFrame, schema: T.StructType, *more) -> DataFrame:
    """One row: count of non-empty raw values per typed column that the load turns into NULL."""
    aggs = [*more, *reject_aggregates(raw, schema)]
    if not aggs:
        aggs = [F.lit(0).cast("long").alias("rejects")]
    return raw.agg(*aggs)


def catalog_columns(tables: ContributionTables, prefix: str = "") -> DataFrame:
    """(table_name, column_name, data_type) of the tables, via the session catalog.

    The tables are registered as temporary views named ``prefix + table``.
    """
    spark = tables.contributions.sparkSession
    rows = []
    for name, df in tables.items():
        view = f"{prefix}{name}"
        df.createOrReplaceTempView(view)
        rows += [(name, c.name, c.dataType) for c in spark.catalog.listColumns(view)]
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string")
