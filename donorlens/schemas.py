"""Fixed schemas of the four contribution tables and the report layout."""

from __future__ import annotations

from pyspark.sql import types as T

# Input contract: every column nullable, types fixed by the source extract.
CANDIDATES = T.StructType([
    T.StructField("cid", T.StringType(), True),
    T.StructField("party", T.StringType(), True),
    T.StructField("cycle", T.IntegerType(), True),
])

COMMITTEES = T.StructType([
    T.StructField("committee_id", T.StringType(), True),
    T.StructField("pac_short", T.StringType(), True),
    T.StructField("party", T.StringType(), True),
])

INDUSTRY_CODES = T.StructType([
    T.StructField("id", T.IntegerType(), True),
    T.StructField("category_code", T.StringType(), True),
    T.StructField("industry_code", T.StringType(), True),
    T.StructField("sector", T.StringType(), True),
])

INDIVIDUAL_CONTRIBUTIONS = T.StructType([
    T.StructField("contributor_id", T.StringType(), True),
    T.StructField("cycle", T.IntegerType(), True),
    T.StructField("recipient_id", T.StringType(), True),
    T.StructField("date", T.DateType(), True),
    T.StructField("amount", T.IntegerType(), True),
    T.StructField("real_code", T.StringType(), True),
    T.StructField("committee_id", T.StringType(), True),
    T.StructField("other_id", T.StringType(), True),
    T.StructField("gender", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("state", T.StringType(), True),
    T.StructField("zip", T.StringType(), True),
])

TABLE_SCHEMAS = {
    "candidates": CANDIDATES,
    "committees": COMMITTEES,
    "industry_codes": INDUSTRY_CODES,
    "individual_contributions": INDIVIDUAL_CONTRIBUTIONS,
}

CONTRIBUTION_COLUMNS = [f.name for f in INDIVIDUAL_CONTRIBUTIONS.fields]

# Segment labels in report order, and the three measure name
# patterns. A report is its key columns followed by, for each segment S in
# this order: Total{S}AmountDonated, Total{S}ContributorSize,
# Average{S}AmountDonated.
SEGMENT_LABELS = ["", "Female", "Male", "FirstTime", "Small", "Large"]
MEASURE_PATTERNS = ["Total{}AmountDonated", "Total{}ContributorSize", "Average{}AmountDonated"]

# Contributor size thresholds (strict comparisons).
SMALL_BELOW = 100
LARGE_ABOVE = 2000


def report_columns(labels=SEGMENT_LABELS) -> list[str]:
    """The 18 statistic column names in report order."""
    return [pattern.format(label) for label in labels for pattern in MEASURE_PATTERNS]


REPORT_COLUMNS = report_columns()
