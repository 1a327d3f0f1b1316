"""Document-corpus engine on Spark DataFrames."""
