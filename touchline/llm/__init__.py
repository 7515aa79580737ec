"""Operators of a training-data pipeline; see ``queries`` for the registered queries.

Nothing else in the library imports this subpackage.
"""
