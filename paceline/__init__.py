"""paceline: analytics over multi-entity sensor time series, declared with Spark DataFrames."""
