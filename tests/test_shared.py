"""Grouping sets, folded contributions, shared reports, decomposable measures, bucketed copies."""

import pytest
from pyspark.sql import functions as F

from donorlens.operators.rollup import grouping_report, pre_aggregate, segment_report
from donorlens.operators.segments import (
    DEFAULT_MEASURES, DEFAULT_SEGMENTS, Segment, State, StateMeasure, largest_gift, quantile, sum_of_squares,
)
from donorlens.plans import reports, shared
from donorlens.plans.checks import plan_text
from donorlens.plans.queries import tables_for
from tests.helpers import contribution as c, make_tables, rows_by


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def cases(spark):
    """Two parties, '' among them, one sector; U1 gives to both parties, U3 to nobody known."""
    return make_tables(
        spark,
        [c("U1", 2000, "N1", 60, real_code="K"), c("U1", 2000, "N2", 50, real_code="K"), c("U2", 2000, "N2", 2001, "M", real_code="K"),
         c("U3", 2000, "X9", 5, real_code="K"), c("U3", 2002, "N1", 7, real_code="none"), c("", 2002, "N1", 99, "", real_code="K")],
        [("N1", "D", 2000), ("N1", "D", 2002), ("N2", "", 2000)], [("C9", "pac", "R")], [(1, "K", "K", "Energy")])


def test_sector_totals_and_parties_by_hand(spark, cases):
    got = rows_by(reports.sector_totals_and_parties(cases), "breakdown", "cycle", "sector", "party")
    assert set(got) == {("sector", 2000, "Energy", None), ("party", 2000, "Energy", "D"), ("party", 2000, "Energy", ""),
                        ("sector", 2002, "Energy", None), ("party", 2002, "Energy", "D")}
    total = got["sector", 2000, "Energy", None]
    assert total["TotalAmountDonated"] == 2116 and total["TotalContributorSize"] == 3  # U1 once, U3 without a party
    assert got["party", 2000, "Energy", ""]["TotalContributorSize"] == 2  # '' is a party, not the total
    # U1's cycle total is 110 in both breakdowns, so U1 is in no size band; U3's is 5
    assert total["TotalSmallContributorSize"] == 1 and got["party", 2000, "Energy", "D"]["TotalSmallContributorSize"] == 0
    assert total["TotalLargeAmountDonated"] == 2001
    # U3 first gave in 2000; the contributor without an id in 2002
    assert got["sector", 2002, "Energy", None]["TotalFirstTimeContributorSize"] == 1


def test_grouping_report_equals_single_reports(spark, sf_small):
    t = tables_for(spark, sf_small)
    whole = reports.sector_totals_and_parties(t)
    assert _rows(whole.where("breakdown = 'sector'").drop("breakdown", "party")) == _rows(reports.by_sector(t))
    assert _rows(whole.where("breakdown = 'party'").drop("breakdown")) == _rows(reports.by_sector_by_party(t))


def test_grouping_needs_the_cycle_and_reads_the_facts_once(spark, cases):
    with pytest.raises(ValueError, match="per cycle"):
        grouping_report(cases.contributions, {"x": ["city"]})
    text = plan_text(reports.sector_totals_and_parties(cases), "simple")
    # the facts enter one aggregate; the sets are expanded above it
    assert text.count("Expand") == 1 and text.index("Expand") < text.index("partial_sum(amount")


def test_all_reports_equal_the_single_ones(spark, sf_small):
    t = tables_for(spark, sf_small)
    together = shared.all_reports(shared.store(shared.fold(t)))
    for name, single in reports.generate_reports(t):
        assert together[name].columns == single.columns, name
        assert _rows(together[name]) == _rows(single), name


def test_all_reports_of_empty_tables(spark):
    t = shared.store(shared.fold(make_tables(spark)))
    assert {name: r.count() for name, r in shared.all_reports(t).items()} == dict.fromkeys(reports.REPORTS, 0)


def _shuffled(df):
    """Records written by each shuffle of an executed plan, by what it is partitioned on."""
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.finalPhysicalPlan())
        if name == "ShuffleQueryStageExec":
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            out.append((node.outputPartitioning().toString(), node.metrics().apply("shuffleRecordsWritten").value()))
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_joins_see_folded_rows_only(spark):
    """Nine tenths of 20,000 rows go to one recipient and have one code, given by 40 contributors."""
    t = make_tables(spark, [c()], [("N1", "D", 2000)], [(f"C{i}", "pac", "R") for i in range(9)], [(1, "K", "K", "Energy")])
    facts = (t.contributions.drop("contributor_id", "recipient_id", "real_code").crossJoin(spark.range(0, 20000, 1, 4)).selectExpr(
        "concat('U', id % 40) AS contributor_id", "IF(id % 10 > 0, 'N1', concat('C', id % 7)) AS recipient_id",
        "IF(id % 10 > 0, 'K', 'L') AS real_code", "*").select(*t.contributions.columns))
    t = t.with_contributions(facts)
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        plain, folded = (reports.by_sector_by_party(x) for x in (
            t, shared.fold(t, ["contributor_id", "cycle", "recipient_id", "real_code"])))
        assert _rows(plain) == _rows(folded)
        most = {k: max(n for p, n in _shuffled(df) if "recipient_id" in p and "contributor_id" not in p)
                for k, df in (("plain", plain), ("folded", folded))}
        assert most["plain"] == 20000
        assert most["folded"] <= 40 * 8  # contributors x recipients
        # the fold itself is combined in each task before its shuffle
        assert max(n for _, n in _shuffled(folded)) <= 4 * 40 * 8
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_bucketed_copy_needs_no_fact_exchange(spark, sf_small):
    t = tables_for(spark, sf_small)
    stored = shared.store(shared.fold(t), buckets=4)
    report = reports.by_cycle(stored)
    text = plan_text(report, "simple")
    assert "Bucketed: true" in text
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert len(shuffles) == 1 and "contributor_id" not in shuffles[0]  # only the few rows per cycle
    assert _rows(report) == _rows(reports.by_cycle(t))
    raw = reports.by_cycle(shared.store(t, buckets=4))
    assert "contributor_id" not in "".join(x for x in plan_text(raw, "simple").splitlines() if "Exchange hash" in x)
    assert _rows(raw) == _rows(report)


def test_state_measures_by_hand(spark, cases):
    measures = [DEFAULT_MEASURES[1], largest_gift(), sum_of_squares(), quantile(0.5, "Median{}AmountDonated")]
    segments = [Segment("", "all"), Segment("Men", "row", "gender = 'M'"), Segment("Later", "contributor", "cycle > first_cycle")]
    got = rows_by(segment_report(cases.contributions, ["cycle"], segments=segments, measures=measures), "cycle")
    year = got[2000]
    assert (year["LargestAmountDonated"], year["SquaredAmountDonated"]) == (2001, 60**2 + 50**2 + 2001**2 + 5**2)
    assert year["MedianAmountDonated"] in (50, 60)
    assert (year["TotalMenContributorSize"], year["LargestMenAmountDonated"]) == (1, 2001)
    assert (year["TotalLaterContributorSize"], year["SquaredLaterAmountDonated"], year["MedianLaterAmountDonated"]) == (0, 0, None)
    assert (got[2002]["LargestLaterAmountDonated"], got[2002]["MedianLaterAmountDonated"]) == (7, 7)


def test_state_measures_do_not_depend_on_folding(spark, sf_small):
    t = tables_for(spark, sf_small)
    kind = dict(segments=DEFAULT_SEGMENTS, measures=[*DEFAULT_MEASURES, largest_gift(), sum_of_squares()])
    folded = t.with_contributions(pre_aggregate(t.contributions, ["contributor_id", "cycle", "recipient_id"], **kind))
    assert _rows(reports.by_cycle_by_party(folded, **kind)) == _rows(reports.by_cycle_by_party(t, **kind))
    # quantile sketches stay within their error: compare with the exact rank
    q = quantile(0.9, "Q{}")
    got = segment_report(t.contributions, ["cycle"], segments=[Segment("", "all")], measures=[q])
    for cycle, value in got.collect():
        below, total = t.contributions.where(F.col("cycle") == cycle).agg(
            F.avg((F.col("amount") <= value).cast("int")), F.avg((F.col("amount") < value).cast("int"))).first()
        assert total - 0.03 <= 0.9 <= below + 0.03


def test_wrong_uses_are_errors(spark, cases):
    with pytest.raises(ValueError, match="state names"):
        StateMeasure("X{}", (State("t", lambda: F.col("amount"), F.sum, F.sum),), lambda s: s)
    other = State("largest", lambda: F.col("amount"), F.min, F.min)
    with pytest.raises(ValueError, match="two different states"):
        segment_report(cases.contributions, ["cycle"], measures=[largest_gift(), StateMeasure("Y{}", (other,), lambda s: s)])
    folded = shared.fold(cases)
    with pytest.raises(ValueError, match="other segments or measures"):
        reports.by_cycle(folded, measures=[largest_gift()])
    with pytest.raises(ValueError, match="not folded"):
        reports.by_cycle_by_party(folded, mode="as_coded")
