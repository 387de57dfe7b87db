"""Operators for preparing training text: one module each, over Spark DataFrames."""
