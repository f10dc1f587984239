"""Content analytics on Spark: DataFrame operators for multi-source text."""
