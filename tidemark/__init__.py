"""tidemark: capture, export and analysis of activity records on Spark DataFrames."""
