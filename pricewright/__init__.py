"""Product-price features and ensembles on Spark DataFrames."""
