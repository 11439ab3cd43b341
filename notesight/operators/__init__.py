"""DataFrame operators: every one takes DataFrames and parameters and returns a lazy DataFrame."""
