"""Find, tokenize and restore personal identifiers in Spark DataFrames."""
