"""Table sources: star-schema fixture mapping, CSV, Parquet, JDBC."""
