"""Operators of a training-data pipeline: one module each, queries in ``queries.py``.

Nothing else in the library imports this package; it uses only the general
session helper of the library.
"""
