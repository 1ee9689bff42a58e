"""Document evidence and training-data operators on Spark DataFrames."""
