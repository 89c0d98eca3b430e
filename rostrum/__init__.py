"""rostrum: cleaning and entity resolution for civic record feeds, on Spark DataFrames."""
