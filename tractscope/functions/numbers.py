"""Whole numbers out of free text."""

from pyspark.sql import Column, functions as F

_WHOLE_PART = r"^\s*([+-]?\d+)(\.\d*)?\s*$"
_ONLY_FRACTION = r"^\s*[+-]?\.\d*\s*$"


def parse_int(text: Column) -> Column:
    """Truncating text-to-int: ``123.7`` is 123, ``NA``, ``1e2`` and overflow are null.

    Works alike with ANSI mode on and off. Plain integers, by far the most
    common text, take the first branch and never meet a regular expression.
    """
    return F.coalesce(
        text.try_cast("int"),
        F.regexp_extract(text, _WHOLE_PART, 1).try_cast("int"),
        F.when(text.rlike(_ONLY_FRACTION), F.lit(0)),
    )


def is_code(text: Column, code: int) -> Column:
    """Numeric equality with a code column that holds text (``1`` or ``1.0``)."""
    return parse_int(text) == F.lit(code)
