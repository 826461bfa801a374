"""Retail and e-commerce analytics as lazy Spark DataFrame functions."""
