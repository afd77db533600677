"""Commerce warehouse and user-tag jobs on Spark DataFrames."""
