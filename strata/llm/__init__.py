"""Operators for preparing language-model training data.

Nothing outside this package imports it.  ``queries`` registers one query per
operator.  Operators take a DataFrame plus the names of its key and text
columns, read only those two columns and return new ones, so extra columns of
any name cannot clash.
"""
