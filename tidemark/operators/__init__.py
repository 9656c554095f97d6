"""Load operators: DataFrames and parameters in, a lazy DataFrame out. Nothing here writes."""
