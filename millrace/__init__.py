"""Document-corpus preparation on Spark DataFrames."""
