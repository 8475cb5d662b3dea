"""Table-to-table operators: DataFrames in, DataFrames out, nothing collected."""
