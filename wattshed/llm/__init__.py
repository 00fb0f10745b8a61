"""Operators for preparing training text, their named queries and SQL twins."""
