"""Strings and lists of strings. Arguments and results are SQL expression text."""

from __future__ import annotations

import re

from scholaudit.functions.sql import literal

# Fixed value: the Unicode white-space characters. Spark's own trim() removes
# only the plain space.
WHITESPACE = (
    " \t\n\u000b\u000c\r\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trim_ws(text: str) -> str:
    """Strip every kind of white space from both ends."""
    return f"btrim({text}, {literal(WHITESPACE)})"


def split_on(text: str, separator: str) -> str:
    """Split at a literal separator."""
    if not separator:
        raise ValueError("separator must not be empty")
    return f"split({text}, {literal(re.escape(separator))})"


def dedupe_string(text: str, separator: str = " ") -> str:
    """Drop repeated parts of a separated list, keeping the first of each.

    A NULL list has no parts, so it gives the empty string.
    """
    return f"coalesce(array_join(array_distinct({split_on(text, separator)}), {literal(separator)}), '')"


def string_agg(items: str, separator: str = " ") -> str:
    """Join the non-null items of one row's array; NULL when there are none."""
    return f"if(exists({items}, item -> item IS NOT NULL), array_join({items}, {literal(separator)}), NULL)"
