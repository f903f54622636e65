"""Readers: relational tables, lake folders, catalog tables, schema discovery."""
