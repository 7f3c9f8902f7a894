"""Comparative genomics over position x sample tables of base calls, as Spark DataFrames."""
