"""Group-disparity analytics on Spark DataFrames."""
