"""emberlog: layered event analytics on Spark DataFrames."""
