"""Operators for preparing training data: documents, vectors, tokens.

Nothing else in the library imports this package.
"""
