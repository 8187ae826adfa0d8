"""Exceptions raised by the loaders and by the run gate."""

from __future__ import annotations


class SpeciationError(Exception):
    """A run or an import cannot continue.

    ``rows`` are a few of the offending rows or totals of them, ``report`` a DataFrame of all where there is one.
    """

    def __init__(self, message: str, rows: list | None = None, report=None):
        self.rows = rows or []
        self.report = report
        shown = "".join(f"\n  {row}" for row in self.rows)
        super().__init__(message + shown)
