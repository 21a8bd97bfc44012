"""Rollcall: entity resolution and lead scoring for business listings, on Spark DataFrames."""
