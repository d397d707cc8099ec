"""playweave: playlist-metadata analytics on Spark DataFrames."""
