"""Queries and layered tables: DataFrames and parameters in, a lazy DataFrame out."""
