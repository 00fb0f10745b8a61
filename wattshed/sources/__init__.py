"""Readers for delimited files, staged worksheets, features and records; writers."""
