"""Marketplace order analytics on Spark DataFrames."""
