"""Retail warehouse and shop-event jobs on Spark DataFrames."""
