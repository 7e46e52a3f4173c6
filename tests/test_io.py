"""Sources and sinks: CSV extracts, Parquet snapshots, flat-file export."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from donorlens.plans import reports
from donorlens.plans.queries import tables_for
from donorlens.sinks.writers import DuplicateKeyError, column_types, run_reports, write_files
from donorlens.sources.files import csv_rejects, read_csv_dir, snapshot, write_csv_dir
from donorlens.schemas import REPORT_COLUMNS


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_csv_roundtrip_gives_same_reports(spark, sf_small):
    t = tables_for(spark, sf_small)
    d = tempfile.mkdtemp(prefix="donorlens-csv-")
    write_csv_dir(t, d)
    back = read_csv_dir(spark, d)
    assert back.contributions.count() == t.contributions.count()
    assert _rows(reports.by_cycle(back)) == _rows(reports.by_cycle(t))
    assert _rows(reports.by_cycle_by_party(back)) == _rows(reports.by_cycle_by_party(t))


def test_csv_extract_format_is_parsed_leniently(spark):
    d = tempfile.mkdtemp(prefix="donorlens-extract-")
    lines = {
        "candidates": ['N1,D,2000', 'N2,,2000'],
        "committees": ['C1,"Friends, of One",R'],
        "industry_codes": ['1,K1,K,Energy'],
        "individual_contributions": [
            'U1,2000,N1,2000-03-04 05:06:07,10,K1,C1,,F,Town,ST,00001',
            'U2,2000,N1,2000-03-04,abc,K1,C1,,M,Town,ST,00001',
            ',2000, C1,not a date,,K1,C1,,,"A, B",ST,00002',
        ],
    }
    for name, rows in lines.items():
        with open(os.path.join(d, f"{name}.csv"), "w") as fh:
            fh.write("\n".join(rows) + "\n")
    t = read_csv_dir(spark, d)
    facts = {r["contributor_id"]: r for r in t.contributions.collect()}
    assert facts["U1"]["date"].isoformat() == "2000-03-04"
    assert facts["U2"]["date"].isoformat() == "2000-03-04" and facts["U2"]["amount"] is None
    assert facts[""]["date"] is None and facts[""]["city"] == "A, B" and facts[""]["recipient_id"] == "C1"
    assert t.committees.first()["pac_short"] == "Friends, of One"
    assert {r["cid"]: r["party"] for r in t.candidates.collect()} == {"N1": "D", "N2": ""}
    rej = csv_rejects(spark, d)["individual_contributions"].first().asDict()
    assert rej == {"record_rejects": 0, "cycle_rejects": 0, "date_rejects": 1, "amount_rejects": 1}
    # a NULL amount still counts its contributor, not the sum or the mean
    r = reports.by_cycle(t).first()
    assert (r["TotalAmountDonated"], r["TotalContributorSize"], r["AverageAmountDonated"]) == (10, 3, 10)
    # strict mode fails on the malformed amount instead
    with pytest.raises(Exception, match="unparseable"):
        read_csv_dir(spark, d, strict=True).contributions.collect()
    assert read_csv_dir(spark, d, strict=True).candidates.count() == 2


def test_csv_roundtrip_keeps_line_breaks_quotes_and_blanks(spark):
    from tests.helpers import contribution as c, make_tables

    odd = ["New\nYork", " Town ", 'the "A", B', "", "a\\b", "\n"]
    t = make_tables(spark, [c(f"U{i}", 2000, "N1", i) for i in range(len(odd))], [("N1", "D", 2000)], [])
    city = F.element_at(F.array(*[F.lit(x) for x in odd]), F.substring("contributor_id", 2, 1).cast("int") + 1)
    t = t.with_contributions(t.contributions.withColumn("city", city))
    d = tempfile.mkdtemp(prefix="donorlens-odd-")
    write_csv_dir(t, d)
    back = read_csv_dir(spark, d).contributions
    assert {r["contributor_id"]: r["city"] for r in back.collect()} == {f"U{i}": x for i, x in enumerate(odd)}
    assert _rows(back) == _rows(t.contributions.select(*back.columns))
    assert csv_rejects(spark, d)["individual_contributions"].first()["record_rejects"] == 0


def _extract(contributions):
    d = tempfile.mkdtemp(prefix="donorlens-extract-")
    lines = {"candidates": ["N1,D,2000"], "committees": ["C1,Friends,R"], "industry_codes": ["1,K1,K,Energy"],
             "individual_contributions": contributions}
    for name, rows in lines.items():
        with open(os.path.join(d, f"{name}.csv"), "w") as fh:
            fh.write("\n".join(rows) + "\n")
    return d


@pytest.mark.parametrize("multiline", [True, False])
def test_records_with_a_wrong_number_of_fields_are_counted_and_refused(spark, multiline):
    good = "U1,2000,N1,2000-03-04,10,K1,C1,,F,Town,ST,00001"
    d = _extract([good, "U2,2000,N1,2000-03-04,10", good + ",more"])
    rej = csv_rejects(spark, d, multiline=multiline)["individual_contributions"].first()
    assert rej["record_rejects"] == 2
    assert read_csv_dir(spark, d, multiline=multiline).contributions.count() == 3
    with pytest.raises(Exception, match="malformed record"):
        read_csv_dir(spark, d, strict=True, multiline=multiline).contributions.count()


def test_strict_refuses_empty_integers_even_in_columns_no_one_reads(spark):
    d = _extract(["U1,2000,N1,2000-03-04,,K1,C1,,F,Town,ST,00001"])
    assert read_csv_dir(spark, d).contributions.count() == 1
    with pytest.raises(Exception, match="unparseable amount"):
        read_csv_dir(spark, d, strict=True).contributions.select("cycle").collect()


def test_numbers_an_integer_cannot_hold_are_rejects(spark):
    from donorlens.schemas import INDIVIDUAL_CONTRIBUTIONS
    from donorlens.sources.files import read_parquet_dir
    from donorlens.sources.tables import normalise, rejects
    from tests.helpers import contribution as c, make_tables

    t = make_tables(spark, [c("U1", 2000, "N1", 1), c("U2", 2000, "N1", 2), c("U3", 2000, "N1", 3)],
                    [("N1", "D", 2000)], [])
    amount = F.expr("CASE contributor_id WHEN 'U1' THEN 2000.75 WHEN 'U2' THEN 30000000000.00 ELSE 7.00 END")
    raw = t.contributions.withColumn("amount", amount)
    got = {r["contributor_id"]: r["amount"] for r in normalise(raw, INDIVIDUAL_CONTRIBUTIONS).collect()}
    assert got == {"U1": None, "U2": None, "U3": 7}
    assert rejects(raw, INDIVIDUAL_CONTRIBUTIONS).first()["amount_rejects"] == 2
    d = tempfile.mkdtemp(prefix="donorlens-decimal-")
    for name, df in t.with_contributions(raw).items():
        df.write.parquet(os.path.join(d, f"{name}.parquet"))
    assert read_parquet_dir(spark, d).contributions.count() == 3
    with pytest.raises(Exception, match="unparseable amount"):
        read_parquet_dir(spark, d, strict=True).contributions.count()


def test_a_keyed_write_computes_the_report_once(spark, sf_small, monkeypatch):
    from donorlens.plans.checks import plan_text
    from donorlens.sinks import writers

    seen = []
    monkeypatch.setattr(writers, "check_unique", lambda report, keys: seen.append(plan_text(report)))
    out = os.path.join(tempfile.mkdtemp(prefix="donorlens-once-"), "r")
    write_files(reports.by_cycle(tables_for(spark, sf_small)), out, keys=["cycle"])
    run_reports([("by_cycle", reports.by_cycle(tables_for(spark, sf_small)))],
                lambda report, name, keys: seen.append(plan_text(report)))
    assert len(seen) == 2 and all("lineitem" not in text and "report-" in text for text in seen)


def test_unknown_report_option_is_an_error(spark, sf_small):
    with pytest.raises(TypeError, match="colour"):
        list(reports.generate_reports(tables_for(spark, sf_small), ["by_cycle"], colour="red"))


def test_snapshot_writes_once(spark, sf_small):
    t = tables_for(spark, sf_small)
    d = tempfile.mkdtemp(prefix="donorlens-snap-")
    snap = snapshot(t, d)
    n = snap.contributions.count()
    assert n == t.contributions.count()
    # a second snapshot over different input leaves the stored one in place
    again = snapshot(t.with_contributions(t.contributions.limit(5)), d)
    assert again.contributions.count() == n
    # an unfinished copy (no _SUCCESS marker) is rewritten
    os.remove(os.path.join(d, "individual_contributions.parquet", "_SUCCESS"))
    redo = snapshot(t.with_contributions(t.contributions.limit(5)), d)
    assert redo.contributions.count() == 5


def test_write_files_and_runner(spark, sf_small):
    t = tables_for(spark, sf_small)
    out = tempfile.mkdtemp(prefix="donorlens-out-")

    def sink(report, name, keys):
        write_files(report, os.path.join(out, name), fmt="csv", keys=keys)

    written = run_reports(reports.generate_reports(t, ["by_cycle", "by_cycle_by_party"]), sink,
                          keys=reports.REPORT_KEYS)
    assert written == ["by_cycle", "by_cycle_by_party"]
    back = spark.read.option("header", "true").option("inferSchema", "true").csv(os.path.join(out, "by_cycle"))
    assert back.columns == ["cycle"] + REPORT_COLUMNS
    assert back.count() == reports.by_cycle(t).count()
    cycles = [r["cycle"] for r in back.collect()]
    assert cycles == sorted(cycles)  # one part file, ordered by the key


def test_write_refuses_duplicate_keys(spark, sf_small):
    t = tables_for(spark, sf_small)
    r = reports.by_cycle(t)
    with pytest.raises(DuplicateKeyError):
        write_files(r.unionByName(r), tempfile.mkdtemp(prefix="donorlens-dup-"), keys=["cycle"])


def test_jdbc_column_types(spark, sf_small):
    t = tables_for(spark, sf_small)
    ddl = column_types(reports.by_cycle_by_party(t))
    # text columns keep the database's own unbounded type
    assert ddl.startswith("cycle INTEGER, TotalAmountDonated BIGINT")
    with pytest.raises(TypeError, match="share"):
        column_types(spark.range(1).selectExpr("0.5D AS share"))


def test_materialise_writes_contributions_once(spark, sf_small):
    from donorlens.plans.checks import plan_text

    t = reports.materialise(tables_for(spark, sf_small))
    text = plan_text(reports.by_cycle(t), "formatted")
    assert "checkpoints" in text or "donorlens-ckpt" in text  # scans the written copy
    assert "lineitem" not in text
    assert _rows(reports.by_cycle(t)) == _rows(reports.by_cycle(tables_for(spark, sf_small)))
    assert t.contributions.where(F.col("amount").isNull()).count() == 0


def test_catalog_columns_and_sample(spark, sf_small):
    from donorlens.operators.basic import preview
    from donorlens.sources.tables import catalog_columns

    t = tables_for(spark, sf_small)
    cols = {(r["table_name"], r["column_name"]): r["data_type"] for r in catalog_columns(t, "t_").collect()}
    assert cols[("individual_contributions", "amount")] == "int"
    assert cols[("candidates", "cycle")] == "int"
    assert len(cols) == 3 + 3 + 4 + 12
    assert t.sample(7).contributions.count() == 7
    assert t.sample(None).contributions.count() == t.contributions.count()
    assert preview(t.contributions, 3).count() == 3


def test_command_line_runner(spark, sf_small):
    from donorlens.__main__ import main

    t = tables_for(spark, sf_small)
    src = tempfile.mkdtemp(prefix="donorlens-cli-src-")
    out = tempfile.mkdtemp(prefix="donorlens-cli-out-")
    write_csv_dir(t, src)
    written = main(["--csv-dir", src, "--out", out, "--format", "parquet",
                    "--reports", "by_cycle", "by_cycle_by_party", "--mode", "as_coded"], spark=spark)
    assert written == ["by_cycle", "by_cycle_by_party"]
    got = spark.read.parquet(os.path.join(out, "by_cycle_by_party"))
    assert _rows(got) == _rows(reports.by_cycle_by_party(t, mode="as_coded"))
