"""Data profiling, set algebra and keyed-search jobs on Spark DataFrames."""
