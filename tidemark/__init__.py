"""Point-in-time customer analytics on Spark DataFrames."""
