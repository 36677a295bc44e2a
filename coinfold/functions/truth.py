"""Truthiness of loosely typed source values that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text forms of values that count as false in the source data.
FALSE_TEXTS = ("", "false", "0", "0.0", "[]", "{}")


def truthy(text: Column) -> Column:
    """True unless the value is missing, empty, zero or false; never null."""
    return F.coalesce(~text.isin(*FALSE_TEXTS), F.lit(False))


def filled(text: Column) -> Column:
    """The value if it is truthy, otherwise null."""
    return F.when(truthy(text), text)


def first_filled(*texts: Column) -> Column:
    """First truthy value. Like ``or`` in the source, the last one is kept as it is."""
    return F.coalesce(*[filled(t) for t in texts[:-1]], texts[-1])


def nonempty(text: Column) -> Column:
    """Text, or null when it is the empty string."""
    return F.nullif(text, F.lit(""))
