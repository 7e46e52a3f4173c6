"""Report plans, the report registry and plan checks."""
