"""Bid-pricing analytics on Spark DataFrames."""
