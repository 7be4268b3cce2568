"""Review analytics on Spark DataFrames."""
