"""Trip and graph analytics on Spark DataFrames."""
