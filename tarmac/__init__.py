"""Road-accident, weather and road-network analytics on Spark DataFrames."""
