"""Differential checks: the rollup plan against other formulations of the same report.

* flat form: windows over raw rows plus one ``count(distinct)`` per segment;
* per-group loop: the original job's shape, one filtered DataFrame and one
  aggregation per (cycle, segment), driven from the driver;
* a property test on random small tables against a pandas brute force.

The flat and loop forms are test oracles only: both put whole groups into
single tasks or run many jobs, which the library avoids.
"""

import pandas as pd
from hypothesis import given, settings, strategies as st

from donorlens.operators.parties import attribute_spec
from donorlens.plans import reports
from donorlens.plans.queries import tables_for
from donorlens.schemas import REPORT_COLUMNS
from tests.helpers import contribution, make_tables
from tools.alt_forms import SEGMENT_SQL, flat_report, loop_report_by_cycle

SEGMENTS = SEGMENT_SQL


def _same(a, b, keys):
    cols = keys + REPORT_COLUMNS
    return sorted(map(tuple, a.select(*cols).collect())) == sorted(map(tuple, b.select(*cols).collect()))


def test_rollup_equals_flat_by_cycle(spark, sf_small):
    t = tables_for(spark, sf_small)
    assert _same(reports.by_cycle(t), flat_report(t.contributions, ["cycle"]), ["cycle"])


def test_rollup_equals_flat_by_party(spark, sf_small):
    t = tables_for(spark, sf_small)
    # flat: windows over all rows first, then drop unattributed rows
    flat = flat_report(attribute_spec(t), ["cycle", "party"], keep="party IS NOT NULL")
    assert _same(reports.by_cycle_by_party(t), flat, ["cycle", "party"])


def test_rollup_equals_per_group_loop_as_coded(spark, sf_small):
    """The original job's loop: filter per cycle, then one aggregation per statistic."""
    t = tables_for(spark, sf_small)
    expected = loop_report_by_cycle(t.contributions)
    got = reports.by_cycle(t, mode="as_coded").select("cycle", *REPORT_COLUMNS).collect()
    assert sorted(map(tuple, got)) == sorted(expected)


def _brute_force(rows):
    df = pd.DataFrame(rows, columns=["contributor_id", "cycle", "amount", "gender"])
    df["first_cycle"] = df.groupby("contributor_id")["cycle"].transform("min")
    df["cycle_total"] = df.groupby(["contributor_id", "cycle"])["amount"].transform("sum")
    preds = {"": lambda d: d.index == d.index, "Female": lambda d: d.gender == "F",
             "Male": lambda d: d.gender == "M", "FirstTime": lambda d: d.cycle == d.first_cycle,
             "Small": lambda d: d.cycle_total < 100, "Large": lambda d: d.cycle_total > 2000}
    out = {}
    for cycle, g in df.groupby("cycle"):
        vals = []
        for label, _ in SEGMENTS:
            s = g[preds[label](g)]
            vals += [int(s.amount.sum()), int(s.contributor_id.nunique()),
                     int(round(s.amount.mean())) if len(s) else 0]
        out[int(cycle)] = tuple(vals)
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["", "A", "B", "C", "D"]), st.sampled_from([1996, 1998, 2000]),
                          st.integers(-50, 2500), st.sampled_from(["F", "M", "", "N"])),
                min_size=1, max_size=40))
def test_property_by_cycle_matches_brute_force(spark, rows):
    t = make_tables(spark, [contribution(c, y, "N1", a, g) for c, y, a, g in rows])
    got = {r["cycle"]: tuple(r[c] for c in REPORT_COLUMNS) for r in reports.by_cycle(t).collect()}
    assert got == _brute_force(rows)
