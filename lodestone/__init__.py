"""Document analytics on Spark: every operator takes and returns DataFrames."""
