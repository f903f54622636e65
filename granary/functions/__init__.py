"""Column helpers. All of them stay inside Spark's own expressions."""
