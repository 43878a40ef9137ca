"""Corpus operators for training-data preparation.

Nothing else in the library imports this subpackage. Each module holds one
operator with its general interface; ``catalog`` registers the queries.
"""
