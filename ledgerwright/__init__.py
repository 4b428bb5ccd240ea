"""Budget-ledger analytics on Spark DataFrames."""
