"""Operators for building training data from text, vectors and pages.

Nothing else in the package imports this one. Operators take and return DataFrames; ``queries`` derives digests from them.
"""
