"""Plan-shape assertions: what Catalyst must (not) produce for the reports."""

from pyspark.sql import functions as F

from donorlens.plans import reports
from donorlens.plans.checks import assert_plan, plan_text
from donorlens.plans.queries import tables_for


def _exchanges(text):
    return sum(1 for line in text.splitlines() if "Exchange hashpartitioning" in line)


def test_by_cycle_has_no_python_no_expand_and_few_shuffles(spark, sf_small):
    t = tables_for(spark, sf_small)
    text = assert_plan(reports.by_cycle(t), absent=("PythonUDF", "ArrowEvalPython", "Expand", "BatchEvalPython"))
    # after the fact is built: level-1 aggregate, contributor window, level-2 aggregate
    simple = plan_text(reports.by_cycle(t), "simple")
    assert "Window" in text
    assert _exchanges(simple) <= 5


def test_top_k_uses_window_group_limit_and_broadcast_tags(spark, sf_small):
    t = tables_for(spark, sf_small)
    df = reports.top_candidates(t)
    df.collect()
    text = plan_text(df, "formatted")
    assert "WindowGroupLimit" in text
    assert "BroadcastHashJoin" in text
    assert "Expand" not in text


def test_reports_read_only_needed_columns(spark, sf_small):
    t = tables_for(spark, sf_small)
    text = plan_text(reports.by_cycle(t), "formatted")
    # the by-cycle report needs neither names nor brands
    lineitem_schema = [ln for ln in text.splitlines() if "ReadSchema" in ln and "l_orderkey" in ln][0]
    assert "l_extendedprice" not in lineitem_schema and "l_shipdate" not in lineitem_schema
    assert "PushedFilters" in text


def test_party_report_single_fact_join_to_bridge(spark, sf_small):
    t = tables_for(spark, sf_small)
    text = plan_text(reports.by_cycle_by_party(t), "formatted")
    assert "Expand" not in text and "PythonUDF" not in text
    assert text.count("Join type: LeftOuter") == 1
    assert "BroadcastHashJoin" in text  # the small bridge is broadcast, facts are not shuffled for it


def test_hot_contributor_and_recipient_are_combined_before_the_shuffle(spark):
    """A third of the rows share one contributor id and one recipient: the result
    matches the flat form and the fact is partially aggregated map-side."""
    from tests.helpers import contribution as c, make_tables
    from tools.alt_forms import flat_report
    from donorlens.operators.parties import attribute_spec
    from donorlens.schemas import REPORT_COLUMNS

    rows = []
    for i in range(300):
        hot = i % 3 == 0
        rows.append(c("" if hot else f"U{i % 40}", 1996 + 2 * (i % 4), "N1" if hot else f"C{i % 7}",
                      (i * 37) % 900 - 20, "FMN"[i % 3]))
    t = make_tables(spark, rows, [("N1", "D", y) for y in (1996, 1998, 2000, 2002)],
                    [(f"C{j}", f"pac {j}", "R" if j % 2 else "D") for j in range(7)])
    got = reports.by_cycle_by_party(t)
    text = plan_text(got, "formatted")
    assert "partial_sum" in text  # map-side combine before the fact shuffle
    want = flat_report(attribute_spec(t), ["cycle", "party"], keep="party IS NOT NULL")
    cols = ["cycle", "party"] + REPORT_COLUMNS
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_sort_merge_and_skew_split_paths_give_same_results(spark, sf_small):
    """With size-based broadcasting off (the large-dimension path) and AQE skew
    splitting forced on every partition, the reports do not change."""
    import contextlib

    from donorlens.plans.queries import QUERIES

    names = ["report_by_cycle_by_party", "report_top_candidates", "report_by_sector_by_party",
             "first_time_contributions", "report_by_cycle_by_party_as_coded"]
    baseline = {n: sorted(map(tuple, QUERIES[n](spark, sf_small).collect())) for n in names}
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1024",
    }

    @contextlib.contextmanager
    def conf(values):
        old = {k: spark.conf.get(k, None) for k in values}
        for k, v in values.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in old.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    with conf(settings):
        for n in names:
            df = QUERIES[n](spark, sf_small)
            assert sorted(map(tuple, df.collect())) == baseline[n], n
            if n == "report_by_cycle_by_party":
                assert "SortMergeJoin" in plan_text(df, "simple")


def test_hot_contributor_and_hot_code_are_split_in_their_joins(spark):
    """Nine tenths of the rows belong to one contributor and cycle, all to one code: with
    sort-merge joins the partitions of these keys are split, and the rows do not change."""
    from donorlens.operators.basic import contributions_by_size
    from donorlens.operators.industry import attribute_sector
    from tests.helpers import contribution as c, make_tables

    t = make_tables(spark, [c("HOT", 2000, "N1", 1)], [("N1", "D", 2000)], [],
                    [(i, f"X{i}", "X", "Energy") for i in range(1, 50)])
    facts = (t.contributions.drop("contributor_id").crossJoin(spark.range(0, 20000, 1, 8))
             .selectExpr("CASE WHEN id % 10 > 0 THEN 'HOT' ELSE concat('U', id) END AS contributor_id", "*")
             .withColumn("city", F.sha2(F.col("id").cast("string"), 256)).drop("id").select(*t.contributions.columns))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = contributions_by_size(facts, large=True)
        assert df.groupBy("contributor_id").count().collect() == [("HOT", 18000)]
        df = contributions_by_size(facts, large=True)
        df.collect()
        assert "skew=true" in plan_text(df, "simple")
        # every row has the same industry code
        df = attribute_sector(t.with_contributions(facts), keep_unmatched=True)
        assert len(df.collect()) == 20000
        assert "skew=true" in plan_text(df, "simple")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
