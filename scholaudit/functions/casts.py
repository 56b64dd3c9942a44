"""Casts for loosely typed input columns in which "NA" stands for missing.

Spark reads more spellings than the input contract allows ('yes' as a
boolean, '2020' as a date). Such text is an error here, never a guess.
Arguments and results are SQL expression text.
"""

from __future__ import annotations

from scholaudit.functions.sql import literal

MISSING = "NA"

# The accepted spellings.
DATE_FORM = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
TIMESTAMP_FORM = (
    r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}"
    r"([ Tt][0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{0,6})?)?"
    r"( ?([Zz]|UTC|[+-][0-9]{1,2}(:[0-9]{2})?))?$"
)
INTEGER_FORM = r"^[+-]?[0-9]+$"
BOOLEAN_FORM = r"^([Tt][Rr][Uu][Ee]|[Ff][Aa][Ll][Ss][Ee])$"


def cast_string(value: str) -> str:
    return f"nullif(string({value}), {literal(MISSING)})"


def _strict(value: str, form: str, target: str) -> str:
    text = cast_string(value)
    complaint = f"raise_error(concat({literal(f'not a valid {target}: ')}, {text}))"
    return (
        f"CASE WHEN {text} IS NULL OR {text} RLIKE {literal(form)} THEN cast({text} AS {target}) "
        f"ELSE cast({complaint} AS {target}) END"
    )


def cast_date(value: str) -> str:
    return _strict(value, DATE_FORM, "date")


def cast_int(value: str) -> str:
    return _strict(value, INTEGER_FORM, "bigint")


def cast_boolean(value: str) -> str:
    return _strict(value, BOOLEAN_FORM, "boolean")


def cast_datetime(value: str) -> str:
    """Timestamp text to its (UTC) date."""
    return f"date({_strict(value, TIMESTAMP_FORM, 'timestamp')})"
