"""Card-transaction analytics and fraud scoring on Spark DataFrames."""
