"""Analysis operators on DataFrames."""
