"""Operators for large training corpora, one module each, plus their queries.

Nothing else in the library imports this subpackage.
"""
