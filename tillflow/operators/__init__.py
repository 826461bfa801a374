"""Operators composed from DataFrame calls."""
