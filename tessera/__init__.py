"""Entity resolution and data processing on Spark DataFrames."""
