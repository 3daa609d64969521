"""Queries that apply the operators to tables at hand, each with its twin in SQL where SQL can express it."""
