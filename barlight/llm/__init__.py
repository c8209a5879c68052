"""Operators for training-data pipelines: sharding, privacy, de-duplication, language, contamination, tokens, search.

Nothing else in the library imports this subpackage.
"""
