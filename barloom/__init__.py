"""barloom: market-analytics feature operators for Spark DataFrames."""
