"""Record and object delivery analytics on Spark DataFrames and streams."""
