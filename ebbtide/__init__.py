"""Customer-attrition analytics on Spark DataFrames, MLlib and Structured Streaming."""
