"""Where data comes from and goes to: raw files, page lots, plain Parquet tables."""
