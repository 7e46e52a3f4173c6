"""Invariants that must hold on any data (checked on the sf0.001 tables)."""

from dataclasses import replace

from pyspark.sql import functions as F

from donorlens.plans import reports
from donorlens.plans.queries import tables_for
from donorlens.schemas import REPORT_COLUMNS


def test_invariants_on_test_data(spark, sf_small):
    t = tables_for(spark, sf_small)
    spec = [r.asDict() for r in reports.by_cycle(t).collect()]
    coded = {r["cycle"]: r.asDict() for r in reports.by_cycle(t, mode="as_coded").collect()}
    contributors = t.contributions.select("contributor_id").distinct().count()
    # every contributor has exactly one first cycle
    assert sum(r["TotalFirstTimeContributorSize"] for r in spec) == contributors
    for r in spec:
        # small and large contributor sets are disjoint
        assert r["TotalSmallContributorSize"] + r["TotalLargeContributorSize"] <= r["TotalContributorSize"]
        assert r["TotalFirstTimeContributorSize"] <= r["TotalContributorSize"]
        # the original job's FirstTime equals its Total; other columns agree with spec mode
        c = coded[r["cycle"]]
        assert (c["TotalFirstTimeAmountDonated"], c["TotalFirstTimeContributorSize"],
                c["AverageFirstTimeAmountDonated"]) == (c["TotalAmountDonated"], c["TotalContributorSize"],
                                                        c["AverageAmountDonated"])
        for k in REPORT_COLUMNS:
            if "FirstTime" not in k:
                assert c[k] == r[k]
    # spec mode gives every contribution at most one party: party totals plus the
    # unmatched recipients' amounts make up the cycle total
    from donorlens.operators.parties import unmatched_recipients

    party = {r["cycle"]: r["amt"] for r in reports.by_cycle_by_party(t).groupBy("cycle")
             .agg(F.sum("TotalAmountDonated").alias("amt")).collect()}
    lost = {r["cycle"]: r["amt"] for r in unmatched_recipients(t).groupBy("cycle")
            .agg(F.sum("amount").alias("amt")).collect()}
    for r in spec:
        assert party.get(r["cycle"], 0) + lost.get(r["cycle"], 0) == r["TotalAmountDonated"]


def test_sector_rows_partition_the_matched_contributions(spark, sf_small):
    t = tables_for(spark, sf_small)
    by_sector = reports.by_sector(t).groupBy("cycle").agg(F.sum("TotalAmountDonated").alias("amt"))
    matched = (t.contributions.join(t.industry_codes, F.col("real_code") == F.col("category_code"), "left_semi")
               .groupBy("cycle").agg(F.sum("amount").alias("amt")))
    assert sorted(map(tuple, by_sector.collect())) == sorted(map(tuple, matched.collect()))
    # with keep_unmatched the sectors add up to the whole cycle
    whole = reports.by_sector(t, keep_unmatched=True).groupBy("cycle").agg(F.sum("TotalAmountDonated").alias("amt"))
    cycle = reports.by_cycle(t).select("cycle", F.col("TotalAmountDonated").alias("amt"))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cycle.collect()))


def test_party_labels_cover_the_fixture_pivot(spark, sf_small):
    from donorlens.operators.industry import party_labels

    assert party_labels(tables_for(spark, sf_small)) == {"D": "D", "R": "R", "I": "I", "L": "L", "": "NONE"}


def test_party_labels_never_collide_and_keep_every_party(spark):
    from donorlens.operators.industry import by_sector_pivot, party_labels
    from tests.helpers import contribution as c, make_tables

    codes = ["", "NONE", "none", "A-B", "A_B", "G"]
    t = make_tables(spark, [c(f"U{i}", 2000, f"N{i}", 10 + i) for i in range(len(codes))],
                    [(f"N{i}", p, 2000) for i, p in enumerate(codes)], [])
    t = t.with_contributions(t.contributions.withColumn("real_code", F.lit("K1")))
    codes_table = spark.createDataFrame([(1, "K1", "K", "Energy")], t.industry_codes.schema)
    t = replace(t, industry_codes=codes_table)
    labels = party_labels(t)
    assert set(labels) == set(codes) and len({v.lower() for v in labels.values()}) == len(codes)
    row = by_sector_pivot(t, labels).first().asDict()
    assert [row[f"{labels[p]}_TotalAmountDonated"] for p in codes] == [10 + i for i in range(len(codes))]


def test_mapping_keeps_every_lineitem_row(spark, sf_small):
    from donorlens.sources.star import contributions_from_star

    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    star = {n: spark.read.parquet(f"{sf_small}/{n}.parquet") for n in names}
    lines = star["lineitem"]
    assert contributions_from_star(star).count() == lines.count() + lines.where("l_partkey % 50 = 0").count()
