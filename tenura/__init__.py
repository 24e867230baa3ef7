"""Tenura: a workforce data warehouse and analytics library on Spark DataFrames."""
