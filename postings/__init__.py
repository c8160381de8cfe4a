"""History of job advertisements as Spark DataFrames."""
