"""Top-k recipients per cycle, and the full statistics for each of them.

Ranking is an aggregate to (cycle, id) followed by ``row_number() <= k`` over
a per-cycle window. Catalyst rewrites that filter into a WindowGroupLimit, so
each map task forwards at most k rows per cycle to the window shuffle; a
cycle's partition never holds all of its recipients.

The ranked list is at most ``k x cycles`` rows, a bound fixed by the caller,
so it is broadcast to tag the contributions without shuffling them.
Contributions to other recipients stay in the plan as context rows: they
count towards a contributor's cycle total and first cycle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from donorlens.functions.expressions import is_candidate, is_committee
from donorlens.operators.parties import candidate_parties, committee_dimension
from donorlens.operators.rollup import amount_column, segment_report
from donorlens.operators.segments import DEFAULT_MEASURES, DEFAULT_SEGMENTS, Measure, Segment
from donorlens.sources.tables import ContributionTables

ATTRIBUTIONS = ("committee", "pass_through", "recipient")


def rank_per_cycle(raised: DataFrame, id_col: str, k: int) -> DataFrame:
    """(cycle, id, raised, rank): rank by amount raised desc, then id asc; rank <= k.

    A NULL id (contributions that go to no ranked kind of recipient) sorts
    after every real id and is dropped after ranking, so it never takes a rank.
    """
    if k < 1:
        raise ValueError("k must be positive")
    w = Window.partitionBy("cycle").orderBy(F.col(id_col).isNull(), F.col("raised").desc_nulls_last(),
                                            F.col(id_col).asc())
    return (raised.withColumn("rank", F.row_number().over(w))
            .where((F.col("rank") <= k) & F.col(id_col).isNotNull()))


def top_recipients(facts: DataFrame, id_expr: Column, id_col: str, k: int) -> DataFrame:
    # No filter on the id before ranking: on a grouping key it would be pushed
    # into the fact scan, make this scan differ from the tagging scan, and stop
    # Spark from sharing the fact shuffle between the two.
    raised = (facts.select("cycle", id_expr.alias(id_col), F.col(amount_column(facts)).alias("amount"))
              .groupBy("cycle", id_col).agg(F.sum("amount").alias("raised")))
    return rank_per_cycle(raised, id_col, k)


def tag_top(facts: DataFrame, id_expr: Column, top: DataFrame, id_col: str) -> DataFrame:
    """Contributions with ``id_col`` set where they go to a top recipient of their cycle."""
    tags = F.broadcast(top.select(F.col("cycle").alias("_tc"), F.col(id_col).alias("_tid")))
    tagged = facts.withColumn("_id", id_expr)
    cond = (F.col("_id") == F.col("_tid")) & (F.col("cycle") == F.col("_tc"))
    return tagged.join(tags, cond, "left").withColumn(id_col, F.col("_tid")).drop("_id", "_tid", "_tc")


def _top_report(facts: DataFrame, id_expr: Column, id_col: str, k: int, dimension: DataFrame,
                dim_on: list[str], segments: list[Segment], measures: list[Measure]) -> DataFrame:
    """Statistics of the top-k per cycle, with their rank and dimension attributes.

    The ranked list (k x cycles rows) takes its dimension attributes first;
    Spark's size check broadcasts the dimension when small and sort-merge
    joins it otherwise. The list is then used twice, to tag contributions and
    to label the statistics, both times joined on (cycle, id): the two uses
    plan identically, so Spark computes the ranking once and reuses it.
    """
    top = top_recipients(facts, id_expr, id_col, k).select("cycle", id_col, "rank")
    ranked = top.join(dimension, dim_on, "left")
    tagged = tag_top(facts, id_expr, ranked, id_col)
    stats = segment_report(tagged, ["cycle", id_col], segments=segments, measures=measures,
                           attributed=F.col(id_col).isNotNull())
    return stats.join(F.broadcast(ranked), ["cycle", id_col])


def top_candidates_report(tables: ContributionTables, *, k: int = 20,
                          segments: list[Segment] = DEFAULT_SEGMENTS,
                          measures: list[Measure] = DEFAULT_MEASURES) -> DataFrame:
    """(cycle, rank, cid, party, statistics): candidates = N-prefixed recipients.

    ``party`` is the candidate's party in that cycle, NULL if not listed.
    """
    id_expr = F.when(is_candidate("recipient_id"), F.col("recipient_id"))
    out = _top_report(tables.contributions, id_expr, "cid", k, candidate_parties(tables), ["cid", "cycle"],
                      segments, measures)
    names = [c for c in out.columns if c not in ("cycle", "cid", "rank", "party")]
    return out.select("cycle", "rank", "cid", "party", *names)


def committee_expr(attribution: str) -> Column:
    """Which committee a contribution counts for.

    committee: the filing committee (committee_id); pass_through: other_id when
    set (the money passed through committee_id to it), else committee_id;
    recipient: the recipient when it is a committee.
    """
    if attribution == "committee":
        c = F.col("committee_id")
    elif attribution == "pass_through":
        c = F.when(F.col("other_id") != "", F.col("other_id")).otherwise(F.col("committee_id"))
    elif attribution == "recipient":
        c = F.when(is_committee("recipient_id"), F.col("recipient_id"))
    else:
        raise ValueError(f"attribution must be one of {ATTRIBUTIONS}")
    return F.when(c != "", c)


def top_committees_report(tables: ContributionTables, *, k: int = 20, attribution: str = "committee",
                          segments: list[Segment] = DEFAULT_SEGMENTS,
                          measures: list[Measure] = DEFAULT_MEASURES) -> DataFrame:
    """(cycle, rank, committee_id, pac_short, party, statistics)."""
    out = _top_report(tables.contributions, committee_expr(attribution), "committee_id", k,
                      committee_dimension(tables), ["committee_id"], segments, measures)
    names = [c for c in out.columns if c not in ("cycle", "committee_id", "rank", "pac_short", "party")]
    return out.select("cycle", "rank", "committee_id", "pac_short", "party", *names)


__all__ = ["rank_per_cycle", "top_recipients", "top_candidates_report", "top_committees_report",
           "committee_expr", "tag_top"]
