"""Column expressions shared by operators. All built-in, JVM-side functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Recipient id prefixes (candidate, committee) and the source
# timestamp format of contribution dates.
CANDIDATE_PREFIX = "N"
COMMITTEE_PREFIX = "C"
SOURCE_DATE_FORMAT = "yyyy-MM-dd HH:mm:ss"
BARE_DATE_FORMAT = "yyyy-MM-dd"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recipient_kind(recipient="recipient_id") -> Column:
    """'candidate' for N-prefixed recipients, 'committee' for C-prefixed, else 'other'."""
    r = col(recipient)
    return (F.when(r.startswith(CANDIDATE_PREFIX), F.lit("candidate"))
            .when(r.startswith(COMMITTEE_PREFIX), F.lit("committee"))
            .otherwise(F.lit("other")))


def is_candidate(recipient="recipient_id") -> Column:
    return col(recipient).startswith(CANDIDATE_PREFIX)


def is_committee(recipient="recipient_id") -> Column:
    return col(recipient).startswith(COMMITTEE_PREFIX)


def lenient_int(c) -> Column:
    """String to int; NULL for empty or malformed text instead of an error."""
    return F.trim(col(c)).try_cast("int")


def lenient_date(c) -> Column:
    """String to date: the source timestamp format, else a bare date, else NULL."""
    s = F.trim(col(c))
    return F.coalesce(
        F.to_date(F.try_to_timestamp(s, F.lit(SOURCE_DATE_FORMAT))),
        F.to_date(F.try_to_timestamp(s, F.lit(BARE_DATE_FORMAT))),
    )


def half_even_ratio(numerator, denominator) -> Column:
    """round-half-even(numerator / denominator) as long; 0 when the denominator is 0.

    This is the average of a segment: Python's round of a mean, i.e. banker's
    rounding, and 0 for an empty segment.
    """
    n, d = col(numerator), col(denominator)
    ratio = F.when(d != 0, n.cast("double") / d.cast("double"))
    return F.coalesce(F.bround(ratio, 0).cast("long"), F.lit(0).cast("long"))


def zero_if_null(c) -> Column:
    return F.coalesce(col(c).cast("long"), F.lit(0).cast("long"))
