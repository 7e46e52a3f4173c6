"""What one task holds, reads and writes where rows are many: plan shapes and file sizes on small rows."""

from donorlens.operators import basic, parties
from donorlens.operators.rollup import grouping_report, segment_report
from donorlens.plans import queries, reports, shared
from donorlens.plans.checks import plan_text
from donorlens.sources import files
from tests.helpers import contribution as c, make_tables


def _tables(spark):
    """Six gifts of one kind and twenty of as many contributors."""
    rows = [c("U0", 2000, "N1", 5)] * 6 + [c(f"U{i}", 2000, "N1", i) for i in range(1, 21)]
    tables = make_tables(spark, rows, [("N1", "D", 2000)], [("C9", "pac", "R")], [(1, "X1", "X1", "Energy")])
    return tables.with_contributions(tables.contributions.repartition(3))


def _partial_over_shuffle(df):
    """Is the lowest aggregate of contributions by many columns fed by a shuffle of its own?"""
    lines = plan_text(df, "simple").splitlines()
    at = max(i for i, line in enumerate(lines) if "HashAggregate" in line and "contributor_id" in line)
    below = [line for line in lines[at + 1:at + 3] if "Exchange" in line]
    return bool(below) and "contributor_id" in below[0] and "REPARTITION_BY_COL" in below[0]


def test_duplicates_are_combined_over_dealt_out_rows(spark):
    df = basic.duplicate_contributions(_tables(spark).contributions)
    assert _partial_over_shuffle(df)
    assert [tuple(r) for r in df.collect()] == [(2000, 1, 5)]


def test_distinct_contributions_by_party_are_combined_over_dealt_out_rows(spark):
    df = parties.contributions_by_party(_tables(spark))
    assert _partial_over_shuffle(parties.attribute_as_coded(_tables(spark)))
    assert [tuple(r) for r in df.collect()] == [(2000, "D", 21, 5 + sum(range(1, 21)))]


def test_as_coded_party_report_over_dealt_out_rows(spark):
    df = reports.by_cycle_by_party(_tables(spark), mode="as_coded")
    assert "REPARTITION_BY_COL" in plan_text(df, "simple")
    row = df.collect()[0]
    assert row["TotalContributorSize"] == 21 and row["TotalAmountDonated"] == 5 + sum(range(1, 21))


def test_as_coded_contributors_are_not_merged_beside_the_distinct_contributions(spark):
    lines = plan_text(reports.by_cycle_by_party(_tables(spark), mode="as_coded"), "simple").splitlines()
    partial = [i for i, line in enumerate(lines)
               if "HashAggregate(keys=[cycle" in line and "contributor_id" in line and "partial_" in line]
    assert partial and all("REPARTITION_BY_COL" in "".join(lines[i + 1:i + 3]) for i in partial)


def test_folds_and_buckets_grow_in_number_not_in_size(spark, monkeypatch):
    tables = _tables(spark)
    assert _partial_over_shuffle(shared.fold(tables).contributions)
    monkeypatch.setattr(shared, "BUCKET_ROWS", 3, raising=False)
    stored = shared.store(shared.fold(tables), buckets=2)
    assert {f.rsplit("_", 1)[1] for f in stored.contributions.inputFiles()} > {"00000.c000.snappy.parquet", "00001.c000.snappy.parquet"}
    assert stored.contributions.count() == 21
    assert [tuple(r) for r in reports.by_cycle(stored).collect()] == [tuple(r) for r in reports.by_cycle(tables).collect()]


def test_grouping_sets_are_not_merged_beside_the_windows(spark):
    tables = _tables(spark)
    rows = parties.attribute_spec(tables, shared.fold(tables).contributions)
    df = grouping_report(rows, {"all": ["cycle"], "party": ["cycle", "party"]})
    assert "Expand" not in plan_text(df, "simple")
    got = {r["grouping"]: r["TotalAmountDonated"] for r in df.collect()}
    total = segment_report(tables.contributions, ["cycle"]).collect()[0]["TotalAmountDonated"]
    assert got == {"all": total, "party": total}


def test_csv_files_hold_a_bounded_number_of_records(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "FILE_RECORDS", 4, raising=False)
    tables = _tables(spark)
    files.write_csv_dir(tables.with_contributions(tables.contributions.coalesce(1)), str(tmp_path))
    sizes = [len(p.read_text().splitlines()) for p in (tmp_path / "individual_contributions.csv").glob("*.csv")]
    assert sum(sizes) == 26 and max(sizes) <= 4
    assert files.read_csv_dir(spark, str(tmp_path)).contributions.count() == 26


def test_load_rejects_writes_the_contributions_once(spark, sf_small, monkeypatch):
    written = []

    def write(tables, folder, *args, names=None, **options):
        written.extend(n for n, _ in tables.items() if names is None or n in names)
        return files.write_csv_dir(tables, folder, *args, **options, **({} if names is None else {"names": names}))

    monkeypatch.setattr(queries, "write_csv_dir", write)
    report = {(r["table_name"], r["metric"]): r["value"] for r in queries.QUERIES["load_rejects"](spark, sf_small).collect()}
    assert sorted(written) == ["candidates", "committees", "industry_codes"]
    assert report["individual_contributions", "record_rejects"] > 0


def _exchanges(df, column):
    return [line for line in plan_text(df, "simple").splitlines() if "Exchange hashpartitioning" in line and column in line]


def test_a_fold_by_all_columns_shuffles_its_rows_once(spark):
    df = shared.fold(_tables(spark)).contributions
    assert len(_exchanges(df, "contributor_id")) == 1
    got = {r["contributor_id"]: (r["_t"], r["_r"]) for r in df.collect()}
    assert got == {"U0": (30, 6), **{f"U{i}": (i, 1) for i in range(1, 21)}}


def test_all_reports_shuffle_no_rows_of_all_groupings(spark, monkeypatch):
    seen = {}
    stored = shared._stored

    def store(df, name):
        seen[name] = df
        key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
        old = spark.conf.get(key)
        out = stored(df, name)
        assert spark.conf.get(key) == old
        return out

    monkeypatch.setattr(shared, "_stored", store)
    monkeypatch.setattr(shared, "GROUP_ROWS", 8, raising=False)
    tables = _tables(spark)
    got = shared.all_reports(shared.store(shared.fold(tables)))
    assert len(_exchanges(seen["all-reports"], "contributor_id")) == 2  # to their groups, to their contributors
    assert any("contributor_id" in x and ", 3)" in x for x in _exchanges(seen["all-reports"], "REPARTITION_BY_NUM"))
    for name, report in reports.generate_reports(tables):
        assert sorted(map(tuple, got[name].collect()), key=str) == sorted(map(tuple, report.collect()), key=str)
