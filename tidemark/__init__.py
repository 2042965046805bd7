"""tidemark: incremental table synchronisation on Spark DataFrames."""
