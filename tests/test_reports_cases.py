"""Hand-computed cases for the report semantics (thresholds, rounding, modes)."""

from pyspark.sql import functions as F

from donorlens.operators import basic, parties
from donorlens.operators.segments import Measure, Segment
from donorlens.plans import checks, reports
from donorlens.schemas import REPORT_COLUMNS
from tests.helpers import contribution as c, make_tables, rows_by


def test_thresholds_genders_and_empty_contributor(spark):
    t = make_tables(spark, [
        c("U1", 2000, amount=99, gender="F"),
        c("U2", 2000, amount=100, gender="M"),
        c("U3", 2000, amount=2000, gender="F"),
        c("U4", 2000, amount=2001, gender="M"),
        c("", 2000, amount=5, gender=""),
        c("U5", 2000, amount=-3, gender="N"),
    ])
    r = rows_by(reports.by_cycle(t), "cycle")[2000]
    assert (r["TotalAmountDonated"], r["TotalContributorSize"], r["AverageAmountDonated"]) == (4202, 6, 700)
    assert (r["TotalFemaleAmountDonated"], r["TotalFemaleContributorSize"]) == (2099, 2)
    assert r["AverageFemaleAmountDonated"] == 1050  # 1049.5 -> even
    assert (r["TotalMaleAmountDonated"], r["TotalMaleContributorSize"]) == (2101, 2)
    assert r["AverageMaleAmountDonated"] == 1050  # 1050.5 -> even
    # 99 and 100: only 99 is small; negative totals are small; '' is one contributor
    assert (r["TotalSmallAmountDonated"], r["TotalSmallContributorSize"], r["AverageSmallAmountDonated"]) == \
        (101, 3, 34)
    # 2000 and 2001: only 2001 is large
    assert (r["TotalLargeAmountDonated"], r["TotalLargeContributorSize"], r["AverageLargeAmountDonated"]) == \
        (2001, 1, 2001)
    assert r["TotalFirstTimeAmountDonated"] == 4202


def test_average_is_half_even_per_row(spark):
    t = make_tables(spark, [
        c("A", 1990, amount=0), c("A2", 1990, amount=1),     # 0.5 -> 0
        c("B", 1992, amount=1), c("B", 1992, amount=2),      # 1.5 -> 2 (per row, one contributor)
        c("C", 1994, amount=2), c("C2", 1994, amount=3),     # 2.5 -> 2
        c("D", 1996, amount=-1), c("D2", 1996, amount=0),    # -0.5 -> 0
        c("E", 1998, amount=3), c("E2", 1998, amount=4),     # 3.5 -> 4
    ])
    got = {k: v["AverageAmountDonated"] for k, v in rows_by(reports.by_cycle(t), "cycle").items()}
    assert got == {1990: 0, 1992: 2, 1994: 2, 1996: 0, 1998: 4}
    assert rows_by(reports.by_cycle(t), "cycle")[1992]["TotalContributorSize"] == 1


def test_first_time_spec_versus_as_coded(spark):
    t = make_tables(spark, [c("U1", 1998, amount=10), c("U1", 2000, amount=20), c("U2", 2000, amount=5)])
    spec = rows_by(reports.by_cycle(t), "cycle")
    coded = rows_by(reports.by_cycle(t, mode="as_coded"), "cycle")
    assert (spec[2000]["TotalFirstTimeAmountDonated"], spec[2000]["TotalFirstTimeContributorSize"]) == (5, 1)
    assert (spec[1998]["TotalFirstTimeAmountDonated"], spec[1998]["TotalFirstTimeContributorSize"]) == (10, 1)
    # the original job looks for the first cycle inside the cycle: always the cycle itself
    assert (coded[2000]["TotalFirstTimeAmountDonated"], coded[2000]["TotalFirstTimeContributorSize"]) == (25, 2)
    for k in REPORT_COLUMNS:
        if "FirstTime" not in k:
            assert spec[2000][k] == coded[2000][k]


PARTY_CANDIDATES = [("N1", "D", 1998), ("N1", "R", 2000), ("N2", "R", 2000)]
PARTY_COMMITTEES = [("C1", "pac one", "D"), ("X7", "no prefix", "L")]
PARTY_FACTS = [
    c("U1", 2000, "N1", 50, "F"),
    c("U1", 2000, "N1", 50, "F"),   # identical copy
    c("U2", 2000, "C1", 30, "M"),
    c("U3", 2000, "N9", 40, "M"),   # unknown recipient
    c("U4", 2000, "X7", 10, "M"),   # listed committee without the C prefix
]


def test_by_party_spec(spark):
    t = make_tables(spark, PARTY_FACTS, PARTY_CANDIDATES, PARTY_COMMITTEES)
    r = rows_by(reports.by_cycle_by_party(t), "cycle", "party")
    assert set(r) == {(2000, "R"), (2000, "D")}
    assert (r[(2000, "R")]["TotalAmountDonated"], r[(2000, "R")]["TotalContributorSize"]) == (100, 1)
    assert (r[(2000, "D")]["TotalAmountDonated"], r[(2000, "D")]["TotalContributorSize"]) == (30, 1)


def test_by_party_as_coded(spark):
    t = make_tables(spark, PARTY_FACTS, PARTY_CANDIDATES, PARTY_COMMITTEES)
    r = rows_by(reports.by_cycle_by_party(t, mode="as_coded"), "cycle", "party")
    # N1 counts for every party it was ever listed under; the copy counts once;
    # L is never proven by a prefixed recipient
    assert set(r) == {(2000, "R"), (2000, "D")}
    assert (r[(2000, "D")]["TotalAmountDonated"], r[(2000, "D")]["TotalContributorSize"]) == (80, 2)
    assert (r[(2000, "R")]["TotalAmountDonated"], r[(2000, "R")]["TotalContributorSize"]) == (50, 1)
    found = rows_by(parties.parties_per_cycle(t), "cycle", "party")
    assert found[(2000, "D")]["by_candidate"] == 1 and found[(2000, "D")]["by_committee"] == 1
    assert found[(2000, "R")]["by_candidate"] == 1 and found[(2000, "R")]["by_committee"] == 0


def test_size_band_uses_whole_cycle_in_spec(spark):
    t = make_tables(spark, [c("U9", 2000, "N1", 60), c("U9", 2000, "C1", 60)],
                    PARTY_CANDIDATES, PARTY_COMMITTEES)
    spec = rows_by(reports.by_cycle_by_party(t), "cycle", "party")
    coded = rows_by(reports.by_cycle_by_party(t, mode="as_coded"), "cycle", "party")
    assert spec[(2000, "R")]["TotalSmallContributorSize"] == 0      # 120 in the cycle
    assert coded[(2000, "R")]["TotalSmallContributorSize"] == 1     # 60 inside the party
    # N1 was also listed under D (1998), so D holds both gifts: 120, not small
    assert (coded[(2000, "D")]["TotalAmountDonated"], coded[(2000, "D")]["TotalSmallAmountDonated"]) == (120, 0)


def test_unmatched_recipients(spark):
    t = make_tables(spark, PARTY_FACTS, PARTY_CANDIDATES, PARTY_COMMITTEES)
    r = rows_by(parties.unmatched_recipients(t), "cycle", "recipient_id")
    assert set(r) == {(2000, "N9"), (2000, "X7")}
    assert r[(2000, "N9")]["recipient_kind"] == "candidate" and r[(2000, "X7")]["recipient_kind"] == "other"


def test_nulls_become_empty_strings(spark):
    t = make_tables(spark, [c(None, 2000, "N1", 10, None), c("U1", 2000, "N1", 5, "F")],
                    [("N1", None, 2000)])
    row = t.contributions.where(F.col("amount") == 10).first()
    assert row["contributor_id"] == "" and row["gender"] == ""
    r = rows_by(reports.by_cycle_by_party(t), "cycle", "party")
    assert set(r) == {(2000, "")}
    assert r[(2000, "")]["TotalContributorSize"] == 2


def test_top_candidates_rank_and_ties(spark):
    t = make_tables(spark, [
        c("U1", 2000, "N3", 50), c("U2", 2000, "N1", 50), c("U3", 2000, "N2", 10),
        c("U1", 2002, "N2", 7), c("U1", 2000, "C1", 999),
    ], [("N1", "D", 2000), ("N2", "R", 2000)])
    r = rows_by(reports.top_candidates(t, k=2), "cycle", "rank")
    assert {k: (v["cid"], v["party"]) for k, v in r.items()} == {
        (2000, 1): ("N1", "D"), (2000, 2): ("N3", None), (2002, 1): ("N2", None)}
    # statistics per candidate; U1's small/large band uses their whole 2000 total (1049)
    assert r[(2000, 2)]["TotalAmountDonated"] == 50 and r[(2000, 2)]["TotalSmallContributorSize"] == 0


def test_top_committees_attribution(spark):
    t = make_tables(spark, [
        c("U1", 2000, "N1", 40, committee_id="C1", other_id="C2"),
        c("U2", 2000, "N1", 30, committee_id="C3", other_id=""),
    ], committees=[("C1", "first", "D"), ("C2", "second", "R")])
    by_filer = rows_by(reports.top_committees(t, k=5), "committee_id")
    assert set(by_filer) == {"C1", "C3"} and by_filer["C1"]["pac_short"] == "first"
    assert by_filer["C3"]["pac_short"] is None
    through = rows_by(reports.top_committees(t, k=5, attribution="pass_through"), "committee_id")
    assert set(through) == {"C2", "C3"} and through["C2"]["party"] == "R"


def test_sector_reports_and_dimension_conflicts(spark):
    t = make_tables(spark, [
        c("U1", 2000, "N1", 10, real_code="K1"), c("U2", 2000, "C1", 20, real_code="K2"),
        c("U3", 2000, "N1", 40, real_code="ZZ"),
    ], [("N1", "D", 2000)], [("C1", "pac", "R")],
        [(1, "K1", "K", "Energy"), (2, "K2", "K", "Finance"), (3, "K2", "K", "Agri")])
    r = rows_by(reports.by_sector(t), "cycle", "sector")
    assert {k: v["TotalAmountDonated"] for k, v in r.items()} == {(2000, "Energy"): 10, (2000, "Agri"): 20}
    keep = rows_by(reports.by_sector(t, keep_unmatched=True), "cycle", "sector")
    assert keep[(2000, "")]["TotalAmountDonated"] == 40
    bp = rows_by(reports.by_sector_by_party(t), "cycle", "sector", "party")
    assert set(bp) == {(2000, "Energy", "D"), (2000, "Agri", "R")}
    wide = rows_by(reports.by_sector_pivot(t, {"D": "Dem", "R": "Rep"}), "cycle", "sector")
    assert wide[(2000, "Energy")]["Dem_TotalAmountDonated"] == 10
    assert wide[(2000, "Energy")]["Rep_TotalContributorSize"] == 0
    from donorlens.operators.industry import party_labels
    assert party_labels(t) == {"D": "D", "R": "R"}
    conflicts = rows_by(checks.dimension_conflicts(t), "table_name")
    assert conflicts["industry_codes"]["conflicting_keys"] == 1


def test_custom_segment_and_measure(spark):
    t = make_tables(spark, [c("U1", 2000, amount=1500), c("U1", 2000, amount=10), c("U2", 2000, amount=5)])
    segments = [Segment("", "all"), Segment("Big", "row", "amount >= 1000")]
    measures = [Measure("Total{}AmountDonated", lambda t_, n, p: F.coalesce(F.sum(t_), F.lit(0))),
                Measure("Max{}ContributorTotal", lambda t_, n, p: F.max(t_))]
    r = reports.by_cycle(t, segments=segments, measures=measures)
    assert r.columns == ["cycle", "TotalAmountDonated", "MaxContributorTotal",
                         "TotalBigAmountDonated", "MaxBigContributorTotal"]
    row = r.first()
    assert (row["TotalAmountDonated"], row["MaxContributorTotal"], row["TotalBigAmountDonated"]) == (1515, 1510, 1500)
    # the same segment as a Column callable, and a contributor-level SQL segment
    alt = reports.by_cycle(t, segments=[Segment("Big", "row", lambda: F.col("amount") >= 1000),
                                        Segment("Mid", "contributor", "cycle_total BETWEEN 10 AND 2000")],
                           measures=measures[:1]).first()
    assert (alt["TotalBigAmountDonated"], alt["TotalMidAmountDonated"]) == (1500, 1510)  # U1: 1510; U2: 5


def test_empty_input_gives_empty_reports(spark):
    t = make_tables(spark, [])
    assert reports.by_cycle(t).count() == 0
    assert reports.by_cycle_by_party(t).count() == 0
    assert basic.overall_measures(t.contributions).first().asDict() == {
        "TotalAmountDonated": 0, "TotalContributorSize": 0, "AverageAmountDonated": 0}


def test_report_schema_is_keys_then_18_non_null_longs(spark):
    t = make_tables(spark, [c("U1", 2000, "N1", 10)], [("N1", "D", 2000)])
    r = reports.by_cycle_by_party(t)
    assert r.columns == ["cycle", "party"] + REPORT_COLUMNS
    for f in r.schema.fields[2:]:
        assert f.dataType.simpleString() == "bigint" and not f.nullable


def test_key_violations_detects_duplicates(spark):
    t = make_tables(spark, [c("U1", 2000), c("U2", 2002)])
    report = reports.by_cycle(t)
    assert checks.key_violations(report, ["cycle"]).count() == 0
    assert checks.key_violations(report.unionByName(report), ["cycle"]).count() == 2
