"""Reusable DataFrame operators, free of table names."""
