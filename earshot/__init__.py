"""Spoken-word mention analytics on Spark DataFrames."""
