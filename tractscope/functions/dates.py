"""Calendar dates out of text whose pattern is known from the source catalog."""

import re

from pyspark.sql import Column, functions as F

_DATE_PART = re.compile(r"^(M+|d+|y+)([^A-Za-z])(M+|d+|y+)\2(M+|d+|y+)$")
_DIGITS = {"y": r"(\d{4})", "M": r"(\d{1,2})", "d": r"(\d{1,2})"}


def _field_order(pattern: str) -> tuple[str, str] | None:
    """Separator and order of year, month and day, if the pattern starts with a date."""
    shape = _DATE_PART.match(pattern.split(" ")[0])
    order = "".join(field[0] for field in shape.group(1, 3, 4)) if shape else ""
    return (shape.group(2), order) if set(order) == set("yMd") else None


def parse_date(text: Column, pattern: str) -> Column:
    """Date of a text such as ``1/5/2012`` or ``2018/03/04 10:00``; null if unreadable.

    Lenient like the sources need it: single-digit months and days are read, and
    whatever follows the date is ignored. The date is rewritten in ISO order and cast.
    The text is used once only: Spark repeats the whole expression in every filter it
    pushes below the projection.
    """
    found = _field_order(pattern)
    if found is None:
        return F.try_to_timestamp(text, F.lit(pattern)).cast("date")
    separator, order = found
    fields = re.escape(separator).join(_DIGITS[field] for field in order)
    iso = "-".join(f"${order.index(field) + 1}" for field in "yMd")
    # A text of another form matches the empty alternative and becomes "--".
    return F.regexp_replace(text, rf"(?s)^\s*(?:{fields}.*|.*)$", iso).try_cast("date")


def parse_date_by(text: Column, patterns: list[tuple[Column, str]]) -> Column:
    """Date of a text whose pattern depends on the row: (condition, pattern) pairs.

    Patterns that differ only after the date share one branch.
    """
    branches: dict = {}
    for holds, pattern in patterns:
        key = _field_order(pattern) or pattern
        known, _ = branches.get(key, (F.lit(False), pattern))
        branches[key] = (known | holds, pattern)
    return F.coalesce(*(F.when(holds, parse_date(text, p)) for holds, p in branches.values()))
