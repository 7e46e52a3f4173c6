"""Report sinks: JDBC tables and flat files."""
