"""Tiny literal tables for hand-written cases."""

from __future__ import annotations

import datetime as dt

from donorlens.schemas import TABLE_SCHEMAS
from donorlens.sources.tables import ContributionTables, normalise_tables

D = dt.date(2000, 1, 1)


def contribution(contributor_id="U1", cycle=2000, recipient_id="N1", amount=10, gender="F",
                 real_code="X1", committee_id="C9", other_id="", date=D, city="", state="", zip=""):
    return (contributor_id, cycle, recipient_id, date, amount, real_code, committee_id, other_id,
            gender, city, state, zip)


def make_tables(spark, contributions=(), candidates=(), committees=(), industry_codes=()) -> ContributionTables:
    data = {"individual_contributions": list(contributions), "candidates": list(candidates),
            "committees": list(committees), "industry_codes": list(industry_codes)}
    return normalise_tables(ContributionTables(**{
        name: spark.createDataFrame(data[name], TABLE_SCHEMAS[name]) for name in TABLE_SCHEMAS
    }))


def rows_by(df, *keys):
    """{key tuple (or single key): row dict}"""
    out = {}
    for r in df.collect():
        d = r.asDict()
        k = tuple(d[c] for c in keys)
        out[k[0] if len(k) == 1 else k] = d
    return out
