"""Operators for training-data pipelines (filters, near duplicates, extraction, output).

Nothing else in the library imports this subpackage; ``queries.py`` holds the registered queries.
"""
