"""Operators for preparing training data, each with a query that applies it to a whole table."""
