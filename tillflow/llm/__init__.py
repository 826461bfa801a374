"""Operators for preparing training data; registered by ``queries`` and SQL in ``sql``."""
