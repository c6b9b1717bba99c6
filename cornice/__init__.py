"""Corporate filings and governance analytics on Spark DataFrames."""
