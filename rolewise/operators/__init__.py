"""Analysis operators: each takes a DataFrame and returns DataFrames."""
