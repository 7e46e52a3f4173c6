"""Relational operators of the reports: rollup, segments, parties, top-k, industry."""
