"""Table-level operators: DataFrames in, one lazy DataFrame out."""
