"""Resource-attribution analytics and corpus processing, expressed on Spark DataFrames."""
