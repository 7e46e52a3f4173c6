"""Contribution reports on Spark: one lazy DataFrame plan per report."""

from donorlens.schemas import REPORT_COLUMNS, TABLE_SCHEMAS
from donorlens.sources.tables import ContributionTables

__all__ = ["REPORT_COLUMNS", "TABLE_SCHEMAS", "ContributionTables"]
