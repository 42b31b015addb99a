"""Operators of a training-data pipeline, and their queries.

Nothing else in the library imports this package; general helpers (the shared
folder) come from the library.
"""
