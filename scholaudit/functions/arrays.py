"""Arrays of structs. Arguments and results are SQL expression text."""

from __future__ import annotations


def any_item(items: str, field: str) -> str:
    """TRUE when some item has the field; FALSE for a NULL or empty array."""
    return f"coalesce(exists({items}, item -> item.{field} IS NOT NULL), FALSE)"


def has_items(items: str) -> str:
    """TRUE when the array holds something; FALSE when it is NULL or empty."""
    return f"coalesce(size({items}) > 0, FALSE)"


def null_if_empty(items: str) -> str:
    return f"if(size({items}) > 0, {items}, NULL)"


def first_green_date(locations: str) -> str:
    """Earliest date among repository copies.

    An undated copy sorts first, so one of them makes the result NULL.
    """
    green = f"filter({locations}, place -> place.host_type = 'repository')"
    return f"get(sort_array(transform({green}, place -> place.oa_date)), 0)"


def repeat_items(counted: str, value: str) -> str:
    """Write out an array of structs with a number ``n``: the value of each ``item`` n times, order kept."""
    return f"flatten(transform({counted}, item -> array_repeat({value}, int(item.n))))"
