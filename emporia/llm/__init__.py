"""Operators for building language-model training corpora.

Nothing else in the library imports this package.  ``queries.load()`` returns
the registered queries and their DuckDB oracles.
"""
