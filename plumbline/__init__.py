"""plumbline: civic geography on Spark DataFrames."""
