"""Document structuring engine on Spark DataFrames."""
