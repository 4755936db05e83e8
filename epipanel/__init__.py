"""Weekly panel analytics and forecasting on Spark DataFrames."""
