"""Spark-native retail lake: dated bronze extracts, conformed silver tables,
gold business tables and the analyses on top of them.

Every operator is a function from DataFrames to a DataFrame. Nothing holds a
global session and nothing reads data at import time.
"""
