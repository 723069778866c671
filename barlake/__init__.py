"""Market-style series analytics on Spark DataFrames."""
