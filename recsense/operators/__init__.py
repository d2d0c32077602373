"""Time-series and table operators: DataFrames in, DataFrames out."""
