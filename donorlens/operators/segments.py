"""Segments (which contributions or contributors) and measures (what number).

A report crosses every segment with every measure. Two kinds of segment:

* ``row`` segments select contributions by a row predicate (gender = 'F').
  A contributor belongs to the segment if any of their rows do.
* ``contributor`` segments select whole contributor-groups by a predicate over
  the contributor rollup columns: ``cycle``, ``first_cycle`` (earliest cycle
  of the contributor) and ``cycle_total`` (their total in that cycle).

Measures aggregate the per-contributor values of one segment:
``seg_total`` (sum of amounts), ``seg_count`` (number of non-null amounts) and
``seg_present`` (the contributor is in the segment).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, functions as F

from donorlens.functions.expressions import half_even_ratio, zero_if_null
from donorlens.schemas import LARGE_ABOVE, MEASURE_PATTERNS, SMALL_BELOW


@dataclass(frozen=True)
class Segment:
    """A named subset. ``predicate`` is a SQL condition string or a
    zero-argument callable returning a Column."""

    label: str
    kind: str  # "all" | "row" | "contributor"
    predicate: Callable[[], Column] | str | None = None

    def __post_init__(self):
        if self.kind not in ("all", "row", "contributor"):
            raise ValueError(f"unknown segment kind {self.kind!r}")
        if self.kind != "all" and self.predicate is None:
            raise ValueError(f"segment {self.label!r} needs a predicate")

    def condition(self) -> Column:
        if isinstance(self.predicate, str):
            return F.expr(self.predicate)
        return self.predicate()


@dataclass(frozen=True)
class Measure:
    """``fn(seg_total, seg_count, seg_present) -> aggregate Column``."""

    pattern: str
    fn: Callable[[Column, Column, Column], Column]

    def name(self, label: str) -> str:
        return self.pattern.format(label)


@dataclass(frozen=True)
class State:
    """What a measure keeps per contributor and report group, so that groups can be merged.

    ``value()`` is the row value, ``update`` the aggregate that turns row values (NULL outside the
    segment) into the state, ``merge`` the aggregate that turns states into one. Both skip NULL.
    """

    name: str
    value: Callable[[], Column]
    update: Callable[[Column], Column]
    merge: Callable[[Column], Column]


# Kept for every report: sum of amounts, number of amounts, number of rows.
BASE_STATES = (
    State("t", lambda: F.col("amount"), F.sum, F.sum),
    State("n", lambda: F.col("amount"), F.count, F.sum),
    State("r", lambda: F.lit(1), F.count, F.sum),
)


@dataclass(frozen=True)
class StateMeasure:
    """A measure with states of its own: ``finish(*merged states) -> Column`` over the whole segment."""

    pattern: str
    states: tuple[State, ...]
    finish: Callable[..., Column]

    def __post_init__(self):
        taken = {s.name for s in BASE_STATES}
        if bad := [s.name for s in self.states if s.name in taken or not s.name.isalpha()]:
            raise ValueError(f"state names {bad}: letters only, none of {sorted(taken)}")

    def name(self, label: str) -> str:
        return self.pattern.format(label)


def states_of(measures) -> list[State]:
    """The states that ``measures`` need, each once; two measures may share a state."""
    out = {s.name: s for s in BASE_STATES}
    for m in measures:
        for s in getattr(m, "states", ()):
            if out.setdefault(s.name, s) is not s:
                raise ValueError(f"two different states are called {s.name!r}")
    return list(out.values())


LARGEST = State("largest", lambda: F.col("amount"), F.max, F.max)
SQUARES = State("squares", lambda: F.col("amount").cast("decimal(20,0)") * F.col("amount").cast("decimal(18,0)"), F.sum, F.sum)


def largest_gift(pattern: str = "Largest{}AmountDonated") -> StateMeasure:
    """The largest single contribution; 0 for an empty segment."""
    return StateMeasure(pattern, (LARGEST,), zero_if_null)


def sum_of_squares(pattern: str = "Squared{}AmountDonated") -> StateMeasure:
    """Sum of squared contributions (with total and count: the variance); 0 for an empty segment."""
    return StateMeasure(pattern, (SQUARES,), zero_if_null)


def quantile(q: float, pattern: str) -> StateMeasure:
    """An approximate quantile of the contributions by mergeable KLL sketches; NULL for an empty segment."""
    sketch = State("sketch", lambda: F.col("amount").cast("long"), F.kll_sketch_agg_bigint, F.kll_merge_agg_bigint)
    return StateMeasure(pattern, (sketch,), lambda s: F.when(F.kll_sketch_get_n_bigint(s) > 0,
                                                               F.kll_sketch_get_quantile_bigint(s, F.lit(q))))


def gender_segment(label: str, code: str) -> Segment:
    return Segment(label, "row", lambda: F.col("gender") == F.lit(code))


def first_time_segment(label: str = "FirstTime") -> Segment:
    return Segment(label, "contributor", lambda: F.col("cycle") == F.col("first_cycle"))


def size_segment(label: str, below: int | None = None, above: int | None = None) -> Segment:
    """Contributors whose cycle total is strictly below / above a threshold."""
    if (below is None) == (above is None):
        raise ValueError("give exactly one of below / above")
    if below is not None:
        return Segment(label, "contributor", lambda: F.col("cycle_total") < F.lit(below))
    return Segment(label, "contributor", lambda: F.col("cycle_total") > F.lit(above))


def total_amount(seg_total: Column, seg_count: Column, seg_present: Column) -> Column:
    return zero_if_null(F.sum(seg_total))


def contributor_size(seg_total: Column, seg_count: Column, seg_present: Column) -> Column:
    return F.count(F.when(seg_present, F.lit(1))).cast("long")


def average_amount(seg_total: Column, seg_count: Column, seg_present: Column) -> Column:
    # mean per contribution row (not per contributor), banker's rounding
    return half_even_ratio(F.sum(seg_total), F.sum(seg_count))


DEFAULT_MEASURES = [
    Measure(MEASURE_PATTERNS[0], total_amount),
    Measure(MEASURE_PATTERNS[1], contributor_size),
    Measure(MEASURE_PATTERNS[2], average_amount),
]

DEFAULT_SEGMENTS = [
    Segment("", "all"),
    gender_segment("Female", "F"),
    gender_segment("Male", "M"),
    first_time_segment("FirstTime"),
    size_segment("Small", below=SMALL_BELOW),
    size_segment("Large", above=LARGE_ABOVE),
]
