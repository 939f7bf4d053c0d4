"""Grounded filings analytics on Spark: operators over DataFrames."""
