"""DataFrame operators: every function takes and returns lazily evaluated DataFrames."""
