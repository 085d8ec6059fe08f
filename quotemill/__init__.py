"""quotemill: versioned securities tables, market queries and data audits on Spark DataFrames."""
