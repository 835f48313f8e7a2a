"""Operators for preparing training data (archives, filters, dedup, mixing, search).

Nothing else in the library imports this subpackage.  Every operator takes DataFrames plus
parameters and returns a DataFrame; ``queries.py`` applies each one to its whole table.
"""
