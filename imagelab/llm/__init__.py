"""Operators that prepare training data from large text, page, conversation and vector tables.

Nothing else in the library imports this subpackage.
"""
