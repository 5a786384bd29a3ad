"""pagetide: incremental analytics over cursor-paginated review pages, on Spark DataFrames."""
