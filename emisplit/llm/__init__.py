"""Operators for preparing training corpora.

Nothing outside this package imports it. Every operator is a function from
DataFrames to DataFrames with its own parameters; ``queries`` registers one
query per operator.
"""
