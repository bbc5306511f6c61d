"""Operators for preparing training text, their queries and their SQL."""
