"""scorefold: learning analytics on Spark DataFrames."""
