"""Transaction-risk analytics on Spark DataFrames."""
