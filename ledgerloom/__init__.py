"""Finance and operations analytics on Spark DataFrames."""
