"""Point-in-time feature and dataset operators for Spark DataFrames."""
