"""Column helpers and totals per group shared by the operators."""

from emisplit.functions.columns import double, inline_table, null_as, store
from emisplit.functions.grouping import SALTS, carried, salted, splittable, totals

__all__ = ["SALTS", "carried", "double", "inline_table", "null_as", "salted", "splittable", "store", "totals"]
