"""Analytics over observation-style listing data, on Spark DataFrames."""
