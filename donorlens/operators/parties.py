"""Party attribution of contributions through the recipient.

A recipient id starting with N is a candidate, with C a committee. Party
membership comes from the candidates table (per candidate and cycle) and the
committees table (per committee, no cycle).

Both attribution modes join the contributions once, on ``recipient_id``, to
a *bridge* built from the two dimension tables. The join is left to Spark's
size-checked strategy selection: a small bridge is broadcast, a large one is
sort-merge joined, with AQE splitting a hot recipient's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from donorlens.functions.expressions import is_candidate, is_committee
from donorlens.operators.basic import dealt_out
from donorlens.operators.rollup import is_pre_aggregated
from donorlens.schemas import CONTRIBUTION_COLUMNS
from donorlens.sources.tables import ContributionTables


def candidate_parties(tables: ContributionTables) -> DataFrame:
    """One party per (cid, cycle); duplicates resolved to the smallest party."""
    return tables.candidates.groupBy("cid", "cycle").agg(F.min("party").alias("party"))


def committee_dimension(tables: ContributionTables) -> DataFrame:
    """One (pac_short, party) per committee id; duplicates resolved by the smallest (party, pac_short)."""
    best = F.min(F.struct("party", "pac_short"))
    return (tables.committees.groupBy("committee_id").agg(best.alias("_best"))
            .select("committee_id", F.col("_best.pac_short").alias("pac_short"),
                    F.col("_best.party").alias("party")))


def committee_parties(tables: ContributionTables) -> DataFrame:
    """One party per committee id: the smallest, i.e. the party ``committee_dimension`` keeps."""
    return tables.committees.groupBy("committee_id").agg(F.min("party").alias("party"))


def spec_bridge(tables: ContributionTables) -> DataFrame:
    """(recipient_id, cycle or NULL, party): N-candidates per cycle, C-committees for any cycle."""
    cand = (candidate_parties(tables).where(is_candidate("cid"))
            .select(F.col("cid").alias("b_recipient"), F.col("cycle").alias("b_cycle"), "party"))
    comm = (committee_parties(tables).where(is_committee("committee_id"))
            .select(F.col("committee_id").alias("b_recipient"),
                    F.lit(None).cast("int").alias("b_cycle"), "party"))
    return cand.unionByName(comm)


def attribute_spec(tables: ContributionTables, facts: DataFrame | None = None) -> DataFrame:
    """Contributions with a ``party`` column, NULL where the recipient is unknown.

    Exactly one output row per contribution (the bridge is unique per key).
    """
    facts = tables.contributions if facts is None else facts
    bridge = spec_bridge(tables)
    cond = ((F.col("recipient_id") == F.col("b_recipient")) &
            (F.col("b_cycle").isNull() | (F.col("b_cycle") == F.col("cycle"))))
    return facts.join(bridge, cond, "left").drop("b_recipient", "b_cycle")


def as_coded_bridge(tables: ContributionTables) -> DataFrame:
    """(recipient_id, party, proven): every party a recipient was ever listed under.

    ``proven`` is true when the listing has the matching prefix (an N id found
    among candidates, a C id among committees); only such listings reveal
    that a party exists in a cycle.
    """
    cand = tables.candidates.select(F.col("cid").alias("b_recipient"), "party",
                                    is_candidate("cid").alias("proven"))
    comm = tables.committees.select(F.col("committee_id").alias("b_recipient"), "party",
                                    is_committee("committee_id").alias("proven"))
    return (cand.unionByName(comm).groupBy("b_recipient", "party")
            .agg(F.max(F.coalesce("proven", F.lit(False))).alias("proven")))


def attribute_as_coded(tables: ContributionTables, facts: DataFrame | None = None) -> DataFrame:
    """Distinct contributions, once per party of their recipient (fan-out intended)."""
    facts = tables.contributions if facts is None else facts
    if is_pre_aggregated(facts):
        raise ValueError("the as-coded party report needs the contributions themselves, not folded ones")
    distinct_facts = dealt_out(facts.select(*CONTRIBUTION_COLUMNS), CONTRIBUTION_COLUMNS).distinct()
    bridge = as_coded_bridge(tables)
    return (distinct_facts.join(bridge, F.col("recipient_id") == F.col("b_recipient"), "inner")
            .drop("b_recipient"))


def parties_per_cycle(tables: ContributionTables) -> DataFrame:
    """Parties reached in each cycle, found separately through candidates and committees.

    (cycle, party, by_candidate, by_committee) with 0/1 flags.
    """
    recipients = tables.contributions.select("cycle", "recipient_id").distinct()
    cand = (tables.candidates.where(is_candidate("cid")).select(F.col("cid").alias("b_recipient"), "party")
            .distinct().withColumn("src", F.lit("candidate")))
    comm = (tables.committees.where(is_committee("committee_id"))
            .select(F.col("committee_id").alias("b_recipient"), "party").distinct()
            .withColumn("src", F.lit("committee")))
    found = recipients.join(cand.unionByName(comm), F.col("recipient_id") == F.col("b_recipient"))
    return found.groupBy("cycle", "party").agg(
        F.max(F.when(F.col("src") == "candidate", 1).otherwise(0)).alias("by_candidate"),
        F.max(F.when(F.col("src") == "committee", 1).otherwise(0)).alias("by_committee"),
    )


def contributions_by_party(tables: ContributionTables) -> DataFrame:
    """Distinct contributions per (cycle, party) as the original job splits them.

    (cycle, party, contributions, amount): the per-party union-distinct sets,
    computed for all parties in one join.
    """
    facts = attribute_as_coded(tables)
    return (facts.groupBy("cycle", "party")
            .agg(F.count(F.lit(1)).alias("contributions"),
                 F.coalesce(F.sum("amount"), F.lit(0)).cast("long").alias("amount"),
                 F.max("proven").alias("proven"))
            .where(F.col("proven")).drop("proven"))


def unmatched_recipients(tables: ContributionTables) -> DataFrame:
    """Recipients with no party in the spec attribution, per cycle.

    (cycle, recipient_id, recipient_kind, contributions, amount).
    """
    from donorlens.functions.expressions import recipient_kind

    # totals first: a hot recipient is one row per task before the shuffle, one row at the join
    totals = tables.contributions.groupBy("cycle", "recipient_id").agg(
        F.count(F.lit(1)).alias("contributions"),
        F.coalesce(F.sum("amount"), F.lit(0)).cast("long").alias("amount"))
    return (attribute_spec(tables, totals).where(F.col("party").isNull())
            .withColumn("recipient_kind", recipient_kind("recipient_id"))
            .select("cycle", "recipient_id", "recipient_kind", "contributions", "amount"))
