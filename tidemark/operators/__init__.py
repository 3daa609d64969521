"""Operators over records and tables, composed of DataFrame operations."""
