"""Relational database source over JDBC.

Each table is read with an explicit column list (Spark prunes the remote
SELECT to the columns a report uses and pushes simple filters into its
WHERE). The contributions table is read in parallel slices of a numeric
column (``cycle`` by default), so many executors pull it at once instead of
one connection streaming the whole table.

The driver jar for the database must be on the Spark classpath; nothing
here is specific to one database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from donorlens.schemas import TABLE_SCHEMAS
from donorlens.sources.tables import ContributionTables, normalise


def read_jdbc_table(spark: SparkSession, url: str, table: str, properties: dict, *,
                    partition_column: str | None = None, lower_bound: int | None = None,
                    upper_bound: int | None = None, num_partitions: int | None = None,
                    fetch_size: int = 10000) -> DataFrame:
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", str(fetch_size)))
    for key, value in properties.items():
        reader = reader.option(key, value)
    if partition_column:
        if None in (lower_bound, upper_bound, num_partitions):
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    df = reader.load()
    return df.select(*[f.name for f in TABLE_SCHEMAS[table].fields]) if table in TABLE_SCHEMAS else df


# SQL of a non-negative integer hash of a text column, per database (used only to cut slices).
HASH_SQL = {
    "postgresql": "abs(hashtext(CAST({column} AS TEXT))::bigint)",
    "mysql": "crc32(CAST({column} AS CHAR))",
    "spark": "CAST(abs(hash(CAST({column} AS STRING)) % 2147483647) AS BIGINT)",
}


def hash_slices(column: str, slices: int, hash_sql: str, *, within: str | None = None,
                values: list[int] | None = None) -> list[str]:
    """WHERE conditions that cut a table into disjoint slices that cover every row.

    A row's slice is the hash of ``column`` modulo ``slices``; rows where it is NULL have a slice of
    their own. With ``within`` and ``values`` (a column and its known values, e.g. the election
    cycles) every value is cut into ``slices`` of its own, so that the database can use an index or
    partitions on it, and rows with another value or NULL there form one more group of slices.
    """
    if slices < 1:
        raise ValueError("slices must be positive")
    if (within is None) != (values is None):
        raise ValueError("within and values go together")
    if values is not None and len(set(values)) != len(values):
        raise ValueError("values must be distinct")
    inside = [f"{column} IS NOT NULL AND {hash_sql.format(column=column)} % {slices} = {i}" for i in range(slices)]
    inside.append(f"{column} IS NULL")
    if not values:
        return inside
    groups = [f"{within} = {int(v)}" for v in values]
    groups.append(f"({within} IS NULL OR {within} NOT IN ({', '.join(str(int(v)) for v in values)}))")
    return [f"{group} AND ({part})" for group in groups for part in inside]


def read_jdbc_slices(spark: SparkSession, url: str, table: str, properties: dict, predicates: list[str]) -> DataFrame:
    """``table`` read by one query per predicate, in parallel."""
    df = spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    return df.select(*[f.name for f in TABLE_SCHEMAS[table].fields]) if table in TABLE_SCHEMAS else df


def read_jdbc_tables(spark: SparkSession, url: str, properties: dict, *,
                     cycle_bounds: tuple[int, int] | None = None, num_partitions: int = 64,
                     strict: bool = False, table_names: dict[str, str] | None = None,
                     slice_by: str | None = None, cycles: list[int] | None = None,
                     hash_sql: str | None = None) -> ContributionTables:
    """The four tables from a database, typed and normalised.

    ``slice_by`` (a text column, e.g. ``contributor_id``) reads the contributions in ``num_partitions``
    hash slices, per cycle where ``cycles`` lists them: a hot cycle is as many queries as a cold
    one is. ``hash_sql`` is the database's hash (``HASH_SQL`` has some). ``cycle_bounds`` (first, last
    cycle) is the plain range read instead; ``table_names`` maps our names to remote names.
    """
    if slice_by and (cycle_bounds or not hash_sql):
        raise ValueError("slice_by needs hash_sql, and no cycle_bounds")
    names = table_names or {}
    out = {}
    for name, schema in TABLE_SCHEMAS.items():
        remote = names.get(name, name)
        kwargs = {}
        if name == "individual_contributions" and slice_by:
            predicates = hash_slices(slice_by, num_partitions, hash_sql, within="cycle" if cycles else None, values=cycles)
            df = read_jdbc_slices(spark, url, remote, properties, predicates)
            out[name] = normalise(df.select(*[f.name for f in schema.fields]), schema, strict=strict)
            continue
        if name == "individual_contributions" and cycle_bounds:
            kwargs = dict(partition_column="cycle", lower_bound=cycle_bounds[0],
                          upper_bound=cycle_bounds[1] + 1, num_partitions=num_partitions)
        df = read_jdbc_table(spark, url, remote, properties, **kwargs)
        out[name] = normalise(df.select(*[f.name for f in schema.fields]), schema, strict=strict)
    return ContributionTables(**out)


def catalog_columns(spark: SparkSession, url: str, properties: dict, schema: str = "public") -> DataFrame:
    """(table_name, column_name, data_type) of a database schema, as a DataFrame."""
    query = ("(SELECT table_name, column_name, data_type FROM information_schema.columns "
             f"WHERE table_schema = '{schema.replace(chr(39), chr(39) * 2)}') AS cols")
    return read_jdbc_table(spark, url, query, properties)
