"""Cloud-spend analytics on Spark DataFrames."""
