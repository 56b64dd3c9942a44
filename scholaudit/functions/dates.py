"""Dates. Arguments and results are SQL expression text."""

from __future__ import annotations


def month_boundary_diff(later: str, earlier: str) -> str:
    """Calendar-month boundaries between two dates (31 Jan to 1 Feb is one)."""
    return f"bigint(year({later}) * 12 + month({later}) - year({earlier}) * 12 - month({earlier}))"


def first_of_month(year: str, month: str) -> str:
    """First day of the month; a month above 12 is unknown, month 0 is an error."""
    return f"if({month} > 12, NULL, make_date(int({year}), int({month}), 1))"
