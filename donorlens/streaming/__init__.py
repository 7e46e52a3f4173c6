"""Intentionally empty.

The reports are batch aggregations over complete tables: nothing in the
job watches a stream, keeps state between runs or handles late data, so
there is no streaming operator to provide.
"""
