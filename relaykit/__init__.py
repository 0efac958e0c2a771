"""Event reporting pipeline on Spark DataFrames."""
