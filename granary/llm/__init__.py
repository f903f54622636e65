"""Operators for training data: text, pages, conversations, vectors. Nothing else in the library imports this."""
