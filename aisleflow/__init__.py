"""In-store retail event analytics on Spark DataFrames and Structured Streaming."""
