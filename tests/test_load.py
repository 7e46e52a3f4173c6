"""Loads that count, snapshots with identity, keyed replacement, and database slices."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from donorlens.plans import reports
from donorlens.plans.queries import tables_for
from donorlens.sinks import keyed
from donorlens.sinks.writers import DuplicateKeyError
from donorlens.sources import load, snapshots
from donorlens.sources.files import table_path, write_csv_dir
from donorlens.sources.jdbc import HASH_SQL, hash_slices, read_jdbc_tables
from tests.helpers import contribution as c, make_tables


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="donorlens-load-")


def _extract(folder, facts):
    lines = {"candidates": ["N1,D,2000", "N2,R,two"], "committees": ["C1,pac,R"], "industry_codes": ["1,K,K,Energy"],
             "individual_contributions": facts}
    for name, rows in lines.items():
        with open(os.path.join(folder, f"{name}.csv"), "w") as fh:
            fh.write("\n".join(rows) + "\n")


GOOD = "U1,2000,N1,2000-03-04 05:06:07,10,K,C1,,F,Town,ST,00001"


def test_one_write_counts_rows_and_rejects(spark, folder):
    _extract(folder, [GOOD, GOOD.replace(",10,", ",ten,"), GOOD.replace("2000-03-04 05:06:07", "soon"), "U9,2000,N1", GOOD.replace(",10,", ",,")])
    loaded = load.store_loaded(load.raw_csv_dir(spark, folder), f"{folder}/stored")
    facts = loaded.counts["individual_contributions"]
    assert facts == {"rows": 5, "cycle_rejects": 0, "date_rejects": 1, "amount_rejects": 1, "record_rejects": 1}
    assert loaded.counts["candidates"] == {"rows": 2, "cycle_rejects": 1, "record_rejects": 0}
    assert loaded.tables.contributions.count() == 5
    assert loaded.tables.contributions.where("amount IS NULL").count() == 3
    report = load.load_report(spark, loaded.counts)
    assert report.where("metric = 'rows'").agg(F.sum("value")).first()[0] == 5 + 2 + 1 + 1
    with pytest.raises(Exception, match="malformed record|unparseable"):
        load.store_loaded(load.raw_csv_dir(spark, folder), f"{folder}/strict", strict=True)


def test_a_clean_extract_has_no_rejects(spark, sf_small, folder):
    t = tables_for(spark, sf_small)
    write_csv_dir(t, folder)
    loaded = load.store_loaded(load.raw_csv_dir(spark, folder), f"{folder}/stored", strict=True)
    assert not any(v for m in loaded.counts.values() for k, v in m.items() if k != "rows")
    assert _rows(reports.by_cycle_by_party(loaded.tables)) == _rows(reports.by_cycle_by_party(t))


def _source(spark, folder, facts):
    t = make_tables(spark, facts, [("N1", "D", 2000)], [("C1", "pac", "R")], [(1, "K", "K", "Energy")])
    for name, df in t.items():
        df.write.mode("overwrite").parquet(table_path(folder, name, ".parquet"))
    return load.raw_parquet_dir(spark, folder)


def test_a_copy_of_another_source_or_schema_is_not_reused(spark, folder):
    source, copy = f"{folder}/source", f"{folder}/copy"
    t = _source(spark, source, [c("U1")])
    with pytest.raises(FileNotFoundError):
        snapshots.open_snapshot(t, copy)
    first = snapshots.refresh_snapshot(t, copy)
    assert not first.reused and first.rows["individual_contributions"] == 1
    again = snapshots.refresh_snapshot(load.raw_parquet_dir(spark, source), copy)
    assert again.reused and again.version == first.version
    # new rows
    t = _source(spark, source, [c("U1"), c("U2")])
    with pytest.raises(snapshots.StaleSnapshotError, match="source"):
        snapshots.open_snapshot(t, copy)
    second = snapshots.refresh_snapshot(t, copy)
    assert not second.reused and second.tables.contributions.count() == 2
    assert first.tables.contributions.count() == 1  # readers of the old version keep it
    # another schema of the same files
    other = t.with_contributions(t.contributions.withColumn("amount", F.col("amount").cast("string")))
    with pytest.raises(snapshots.StaleSnapshotError, match="schemas"):
        snapshots.open_snapshot(other, copy)
    assert _rows(snapshots.row_counts(second))[0] == ("candidates", 1)


def test_a_failed_extract_leaves_the_published_copy(spark, folder):
    source, copy = f"{folder}/source", f"{folder}/copy"
    t = _source(spark, source, [c("U1")])
    first = snapshots.refresh_snapshot(t, copy, source="day 1")
    broken = t.with_contributions(t.contributions.withColumn("amount", F.expr("raise_error('disk')").cast("int")))
    with pytest.raises(Exception, match="disk"):
        snapshots.refresh_snapshot(broken, copy, source="day 2")
    assert snapshots.open_snapshot(t, copy, source="day 1").version == first.version
    with pytest.raises(ValueError, match="reads no files"):
        snapshots.source_fingerprint(make_tables(spark))


def test_only_the_computed_cycles_are_replaced(spark, folder):
    def report(rows):
        return spark.createDataFrame(rows, "cycle int, party string, total long")

    path, keys = f"{folder}/report", ["cycle", "party"]
    whole = keyed.replace_groups(report([(2000, "D", 1), (2000, "R", 2), (2002, "D", 3)]), path, keys)
    assert whole.columns == ["cycle", "party", "total"] and whole.count() == 3
    whole = keyed.replace_groups(report([(2002, "", 9)]), path, keys)
    assert _rows(whole) == [(2000, "D", 1), (2000, "R", 2), (2002, "", 9)]
    with pytest.raises(DuplicateKeyError):
        keyed.replace_groups(report([(2002, "D", 1), (2002, "D", 2)]), path, keys)
    with pytest.raises(ValueError, match="NULL"):
        keyed.replace_groups(report([(None, "D", 1)]), path, keys)
    with pytest.raises(keyed.MixedSchemaError, match="total"):
        keyed.replace_groups(report([(2002, "D", 1)]).withColumn("total", F.lit("x")), path, keys)
    with pytest.raises(ValueError, match="one of the keys"):
        keyed.replace_groups(report([(2002, "D", 1)]), path, keys, by="total")
    assert _rows(keyed.read_report(spark, path, whole.schema)) == [(2000, "D", 1), (2000, "R", 2), (2002, "", 9)]
    # no rows: nothing is replaced
    assert keyed.replace_groups(report([]), path, keys).count() == 3


@pytest.mark.parametrize("within", [None, "cycle"])
def test_slices_are_disjoint_and_cover_every_row(spark, within):
    rows = [(None if i % 7 == 0 else f"U{i % 50}", None if i % 11 == 0 else 1996 + 2 * (i % 4)) for i in range(500)]
    df = spark.createDataFrame(rows, "contributor_id string, cycle int")
    values = [1996, 1998, 2000] if within else None  # 2002 is not listed
    slices = hash_slices("contributor_id", 8, HASH_SQL["spark"], within=within, values=values)
    assert len(slices) == 9 * (4 if within else 1)
    hits = df.select(sum((F.coalesce(F.expr(s), F.lit(False))).cast("int") for s in slices).alias("n"))
    assert {r["n"] for r in hits.collect()} == {1}
    sizes = [df.where(s).count() for s in slices]
    assert sum(n > 0 for n in sizes) > len(sizes) // 2


def test_slice_arguments(spark):
    for bad in (dict(slices=0), dict(slices=2, within="cycle"), dict(slices=2, within="cycle", values=[1, 1])):
        with pytest.raises(ValueError):
            hash_slices("x", hash_sql="h({column})", **bad)
    with pytest.raises(ValueError, match="hash_sql"):
        read_jdbc_tables(spark, "jdbc:none", {}, slice_by="contributor_id")
