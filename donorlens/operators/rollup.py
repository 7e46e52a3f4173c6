"""Contributor rollup: the core of every report.

A report is ``keys + segments x measures`` over groups of contributions. The
distinct-contributor counts make a naive plan expensive (one
``count(distinct)`` per segment compiles to an Expand plus an extra shuffle
each), so the work is done in two aggregation levels instead:

1. **Level 1** groups contributions by ``(keys, contributor_id)``. Each row is
   one contributor inside one report group, with their amount sum, amount
   count, row count, and the same three numbers restricted to each row-level
   segment. Map-side partial aggregation collapses hot contributors (an empty
   contributor id can be a large share of all rows) before the shuffle.
2. **Contributor columns** on the level-1 rows: ``first_cycle`` (earliest
   cycle of the contributor over all contributions) and ``cycle_total`` (their
   total in the cycle over all contributions). These are windows over level-1
   rows, whose size per contributor is bounded by the number of report groups
   they reach, never by their number of contributions.
3. **Level 2** groups level-1 rows by ``keys``; distinct counts become plain
   counts of level-1 rows.

Context rows: contributions outside every report group (unknown recipient,
unmatched industry code) still count towards a contributor's cycle total and
first cycle in ``spec`` mode. Callers mark report rows with a boolean
``attributed`` column; the others are folded into one level-1 row per
contributor and cycle and dropped before level 2.

Pre-aggregated facts: ``pre_aggregate`` folds the contributions by any columns a report reads
(contributor, cycle, recipient, code, ...) into rows that hold the same numbers as states. Every
function here takes such rows for contributions: level 1 then merges states, so dimension joins
between the two see aggregated rows only, and one stored copy serves several reports.

``as_coded`` mode reproduces the original job: the first cycle and the
size band are computed inside each report group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from donorlens.operators.segments import DEFAULT_MEASURES, DEFAULT_SEGMENTS, Segment, StateMeasure, states_of

ATTRIBUTED = "_attributed"
MODES = ("spec", "as_coded")


def state_columns(segments, measures):
    """(column, state, row condition or None) of every state, for all rows and per row-level segment."""
    states = states_of(measures)
    out = [(f"_{s.name}", s, None) for s in states]
    for i, seg in enumerate(segments):
        if seg.kind == "row":
            out += [(f"_{s.name}{i}", s, seg.condition) for s in states]
    return out


def is_pre_aggregated(facts: DataFrame) -> bool:
    return "_t" in facts.columns


def amount_column(facts: DataFrame) -> str:
    """The column whose sum is the amount, of contributions or of pre-aggregated rows."""
    return "_t" if is_pre_aggregated(facts) else "amount"


def state_aggregates(rows: DataFrame, segments, measures) -> list[Column]:
    """Aggregates that build the states from contributions, or merge those of pre-aggregated rows."""
    columns = state_columns(segments, measures)
    if is_pre_aggregated(rows):
        if missing := [c for c, _, _ in columns if c not in rows.columns]:
            raise ValueError(f"pre-aggregated for other segments or measures: no {missing}")
        return [s.merge(F.col(c)).alias(c) for c, s, _ in columns]
    return [s.update(s.value() if cond is None else F.when(cond(), s.value())).alias(c) for c, s, cond in columns]


def pre_aggregate(facts: DataFrame, by: list[str], *, segments: list[Segment] = DEFAULT_SEGMENTS,
                  measures: list = DEFAULT_MEASURES) -> DataFrame:
    """One row per value of ``by`` with the states of its contributions (combined map-side)."""
    return facts.groupBy(*by).agg(*state_aggregates(facts, segments, measures))


def contributor_rollup(facts: DataFrame, keys: list[str], *, mode: str = "spec",
                       segments: list[Segment] = DEFAULT_SEGMENTS,
                       measures: list = DEFAULT_MEASURES,
                       attributed: Column | None = None,
                       carry_max: list[str] | None = None) -> DataFrame:
    """Level 1 plus contributor columns. One row per (keys, contributor) in a report group."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if "cycle" not in keys:
        raise ValueError("every report is per cycle: keys must include 'cycle'")
    has_context = attributed is not None
    # one projection: report keys (NULL on context rows, except the cycle), the
    # attribution flag when there are context rows, and every other column the
    # segments may read
    key_cols = [F.col(k) if k == "cycle" or not has_context else F.when(attributed, F.col(k)).alias(k)
                for k in keys]
    flag_cols = [attributed.alias(ATTRIBUTED)] if has_context else []
    rows = facts.select(*[c for c in facts.columns if c not in keys and c != ATTRIBUTED],
                        *key_cols, *flag_cols)

    aggs = state_aggregates(rows, segments, measures)
    for c in carry_max or []:
        aggs.append(F.max(c).alias(c))

    group = [*keys, "contributor_id"] + ([ATTRIBUTED] if has_context else [])
    level1 = rows.groupBy(*group).agg(*aggs)

    if mode == "as_coded":
        # first cycle and size band inside the report group (the group has one cycle)
        contributor_cols = {"first_cycle": F.col("cycle"), "cycle_total": F.col("_t")}
    else:
        first = F.min("cycle").over(Window.partitionBy("contributor_id"))
        if keys == ["cycle"] and not has_context:
            total = F.col("_t")
        else:
            total = F.sum("_t").over(Window.partitionBy("contributor_id", "cycle"))
        contributor_cols = {"first_cycle": first, "cycle_total": total}
    level1 = level1.withColumns(contributor_cols)
    if has_context:
        level1 = level1.where(F.col(ATTRIBUTED))
    return level1


def aggregate_segments(rollup: DataFrame, keys: list[str], *,
                       segments: list[Segment] = DEFAULT_SEGMENTS,
                       measures: list = DEFAULT_MEASURES,
                       carry_max: list[str] | None = None) -> DataFrame:
    """Level 2: keys + one column per (segment, measure), in segment-major order."""
    aggs, names = [], []
    for i, seg in enumerate(segments):
        suffix = str(i) if seg.kind == "row" else ""
        pred = F.coalesce(seg.condition(), F.lit(False)) if seg.kind == "contributor" else None

        def state(name, suffix=suffix, pred=pred):
            c = F.col(f"_{name}{suffix}")
            return c if pred is None else F.when(pred, c)

        present = F.col(f"_r{suffix}") > 0
        present = present if pred is None else pred & present
        for m in measures:
            name = m.name(seg.label)
            if isinstance(m, StateMeasure):
                value = m.finish(*[s.merge(state(s.name)) for s in m.states])
            else:
                value = m.fn(state("t"), state("n"), present)
            aggs.append(value.alias(name))
            names.append(name)
    for c in carry_max or []:
        aggs.append(F.max(c).alias(c))
    out = rollup.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *names, *(carry_max or []))


def segment_report(facts: DataFrame, keys: list[str], *, mode: str = "spec",
                   segments: list[Segment] = DEFAULT_SEGMENTS,
                   measures: list = DEFAULT_MEASURES,
                   attributed: Column | None = None,
                   carry_max: list[str] | None = None) -> DataFrame:
    """keys + segments x measures over ``facts`` (one lazy plan, no action)."""
    rollup = contributor_rollup(facts, keys, mode=mode, segments=segments, measures=measures,
                                attributed=attributed, carry_max=carry_max)
    return aggregate_segments(rollup, keys, segments=segments, measures=measures, carry_max=carry_max)


def grouping_report(facts: DataFrame, sets: dict[str, list[str]], *,
                    segments: list[Segment] = DEFAULT_SEGMENTS, measures: list = DEFAULT_MEASURES,
                    partitions: int | None = None) -> DataFrame:
    """Several report groupings of one fact pass: (grouping, all key columns, statistics).

    ``sets`` maps a label to its key columns, ``cycle`` among them. A row's ``grouping`` is the label;
    keys outside its set are NULL. A contribution whose key is NULL is in none of the sets with
    that key, but its contributor's totals and first cycle count it. Spec mode.

    Level 1 groups the facts once by all keys and the contributor; the grouping sets are taken over
    these contributor-level rows, so a contributor with several values of a finer key is one row of the
    coarser set and counts once there. An empty text is a value: sets are told apart by
    ``grouping_id`` or their label, never by NULL.

    ``partitions`` of pre-aggregated facts: level-1 rows are dealt to so many tasks by contributor, where
    they meet for the windows and are merged per set without another shuffle. The number must follow the rows, since
    a task holds a table of its rows in all sets.
    """
    if bad := [label for label, keys in sets.items() if "cycle" not in keys]:
        raise ValueError(f"every report is per cycle: {bad}")
    keys = ["cycle", *dict.fromkeys(k for s in sets.values() for k in s if k != "cycle")]
    group = [*keys, "contributor_id"]
    folded = is_pre_aggregated(facts)
    if folded:  # combined before: its rows are grouped in tasks of the session's advisory size
        facts = facts.repartition(*group)
    level1 = facts.groupBy(*group).agg(*state_aggregates(facts, segments, measures))
    if folded and partitions:
        level1 = level1.repartition(partitions, "contributor_id")
    level1 = level1.withColumns({
        "first_cycle": F.min("cycle").over(Window.partitionBy("contributor_id")),
        "cycle_total": F.sum("_t").over(Window.partitionBy("contributor_id", "cycle"))})
    if folded:
        rows = _merged_by_place(level1, sets, group, segments, measures, meet=not partitions)
        return aggregate_segments(rows, ["grouping", *keys], segments=segments, measures=measures)
    merged = level1.groupingSets([[*s, "contributor_id"] for s in sets.values()], *group).agg(
        F.grouping_id().alias("_set"), *state_aggregates(level1, segments, measures),
        F.max("first_cycle").alias("first_cycle"), F.max("cycle_total").alias("cycle_total"))
    label = F.lit(None)
    for name, own in sets.items():
        number = sum(1 << (len(group) - 1 - i) for i, c in enumerate(group) if c not in (*own, "contributor_id"))
        inside = F.col("_set") == number
        for k in own:
            if k != "cycle":
                inside = inside & F.col(k).isNotNull()
        label = F.when(inside, F.lit(name)).otherwise(label)
    rows = merged.withColumn("grouping", label).where(F.col("grouping").isNotNull())
    return aggregate_segments(rows, ["grouping", *keys], segments=segments, measures=measures)


def _merged_by_place(level1: DataFrame, sets: dict[str, list[str]], group: list[str], segments, measures,
                     meet: bool) -> DataFrame:
    """Level-1 rows merged per grouping set (``grouping``), its keys and contributor.

    A row is taken to the sets that hold it, and these rows are shuffled to their groups before they
    are merged (``meet``), unless the tasks of the windows are small enough: merging beside the windows would need a table of all sets over the windows' narrow input.
    """
    places = []
    for name, own in sets.items():
        place = F.struct(F.lit(name).alias("grouping"),
                         *[(F.col(k) if k in own else F.lit(None).cast(level1.schema[k].dataType)).alias(k)
                           for k in group[:-1]])
        inside = F.lit(True)
        for k in own:
            if k != "cycle":
                inside = inside & F.col(k).isNotNull()
        places.append(F.when(inside, place))
    rows = level1.select(*[c for c in level1.columns if c not in group[:-1]],
                         F.explode(F.array_compact(F.array(*places))).alias("_place"))
    rows = rows.select("_place.*", *[c for c in rows.columns if c != "_place"])
    if meet:
        rows = rows.repartition("grouping", *group)
    return rows.groupBy("grouping", *group).agg(
        *state_aggregates(rows, segments, measures),
        F.max("first_cycle").alias("first_cycle"), F.max("cycle_total").alias("cycle_total"))
