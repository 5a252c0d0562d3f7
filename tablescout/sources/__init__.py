"""Table sources: CSV, JSON, header'd delimited text and Parquet."""
