"""voxloom: dialogue, timeline and signal analytics on Spark DataFrames."""
