"""Content-intelligence operators expressed as Spark DataFrames."""
