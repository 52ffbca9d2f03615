"""Exact decimal helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WIDE = "decimal(38,18)"


def _checked(text: Column, value: Column, what: str) -> Column:
    """``value``, or a failed batch where text is present but no value came out."""
    bad = text.isNotNull() & value.isNull()
    message = F.concat(F.lit(f"{what}: cannot load "), text)
    return F.when(bad, F.raise_error(message)).otherwise(value)


def number_or_fail(text: Column, kind: T.DecimalType, what: str) -> Column:
    """Text to a rounded decimal (half up); bad or oversized text fails the batch."""
    value = F.trim(text).try_cast(_WIDE).try_cast(kind)
    return _checked(text, value, what)


def whole_or_fail(text: Column, what: str) -> Column:
    """Text to a nullable integer; ``700`` and ``700.0`` pass, ``700.5`` fails."""
    exact = F.trim(text).try_cast(_WIDE)
    whole = F.when(exact == F.floor(exact), exact).try_cast("int")
    return _checked(text, whole, what)


def exact_ratio(total: Column, count: Column, digits: int = 2) -> Column:
    """``total / count`` with enough digits kept for the one rounding to be right."""
    return F.round(total.cast("decimal(25,2)") / count.cast("decimal(18,0)"), digits)


def exact_avg(value: Column, digits: int = 2) -> Column:
    """Average of a decimal column rounded once.

    ``avg`` on decimals already rounds to a few more digits, so rounding its
    result can be a unit off at a tie.
    """
    return exact_ratio(F.sum(value), F.count(value), digits)


def money(value: Column) -> Column:
    return value.cast("decimal(38,2)")
