"""Operators of a large-scale training-data pipeline, one module each.

Nothing else in the library imports this subpackage; ``__spark_entry__``
registers its queries only when the subpackage is there.
"""
