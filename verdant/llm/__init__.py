"""Operators for building training data from web-scale corpora.

Nothing else in the library imports this subpackage. ``queries.QUERIES`` and
``queries.ORACLE`` list its registered queries.
"""
