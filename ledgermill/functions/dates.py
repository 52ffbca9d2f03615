"""Date parsing and keys that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A time of day: 24-hour, or 12-hour with AM or PM; seconds, fraction and zone may be missing.
_TIME = r"([01]?\d|2[0-3]):([0-5]\d)(?::([0-5]\d)(?:[.,]\d+)?)?\s*([AaPp][Mm])?\s*(?:Z|[+-]\d{2}:?\d{2})?"
_CLOCK = r"[T ]\s*" + _TIME + r"\z"

# A numeric date, then nothing or a time of day.
_TAIL = r"(?:[T ]\s*" + _TIME + r")?\z"
_YEAR_FIRST = r"\A(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _TAIL
_YEAR_LAST = r"\A(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})" + _TAIL
_SHORT_YEAR = r"\A(\d{1,2})[-/.](\d{1,2})[-/.](\d{2})" + _TAIL
_COMPACT = r"\A(\d{4})(\d{2})(\d{2})" + _TAIL
_MONTH_ONLY = r"\A(\d{4})-(\d{2})\z"

# Spelled-out month layouts, tried after the numeric ones.
_NAMED_MONTHS = ("d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy")

_ANY_CLOCK = r"[T ]\s*\d{1,2}:"

# The layouts nearly all values have, tried first because they need one match only.
_PLAIN_DATE = r"\A\d{4}-\d{2}-\d{2}\z"
_PLAIN_TIMESTAMP = r"\A\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(?:\.\d+)?\z"


def _as_date(text: Column, pattern: str, order: str) -> Column:
    return F.when(text.rlike(pattern), F.regexp_replace(text, pattern, order)).try_cast("date")


def _short_year(text: Column, month: str, day: str) -> Column:
    """Two-digit years: 69 to 99 are of the last century, the others of this one."""
    year = F.regexp_extract(text, _SHORT_YEAR, 3)
    century = F.when(year >= "69", F.lit("19")).otherwise(F.lit("20"))
    rest = F.regexp_replace(text, _SHORT_YEAR, f"-{month}-{day}")
    return F.when(text.rlike(_SHORT_YEAR), F.concat(century, year, rest)).try_cast("date")


def parse_date(text: Column) -> Column:
    """Text to date, trying every layout for each value; unreadable text gives null.

    Year first, then month-day-year, then day-month-year (so ``05-08-2023`` is
    8 May and ``15-08-2023`` is 15 August), also with two-digit years, then
    spelled-out months. Behind a numeric date only a time of day may stand.
    """
    t = F.trim(text)
    return F.coalesce(
        F.when(t.rlike(_PLAIN_DATE), t).try_cast("date"),
        _as_date(t, _YEAR_FIRST, "$1-$2-$3"),
        _as_date(t, _YEAR_LAST, "$3-$1-$2"),
        _as_date(t, _YEAR_LAST, "$3-$2-$1"),
        _short_year(t, "$1", "$2"),
        _short_year(t, "$2", "$1"),
        _as_date(t, _COMPACT, "$1-$2-$3"),
        _as_date(t, _MONTH_ONLY, "$1-$2-1"),
        *[F.try_to_date(t, layout) for layout in _NAMED_MONTHS],
    )


def parse_timestamp(text: Column) -> Column:
    """Text to a zone-less timestamp cut to whole seconds; unreadable text gives null.

    The rarer layouts are tried inside ``transform``, which Spark doesn't compile
    into the code of the whole row: with them that is too long for the JVM to
    compile in turn, and every plain value pays for it.
    """
    t = F.trim(text)
    return F.coalesce(
        F.when(t.rlike(_PLAIN_TIMESTAMP), F.substring(t, 1, 19)).try_cast("timestamp_ntz"),
        F.get(F.transform(F.array(t), _rarer_timestamp), F.lit(0)),
    )


def _rarer_timestamp(t: Column) -> Column:
    part = lambda k: F.regexp_extract(t, _CLOCK, k)
    hour, half = part(1).try_cast("int"), F.lower(part(4))
    # on a 12-hour clock 12 is the hour before 1; an hour beyond 12 is no time
    hour = (
        F.when(half == "", hour)
        .when(hour.between(1, 12), hour % 12 + F.when(half == "pm", 12).otherwise(0))
    )
    seconds = F.coalesce(F.nullif(part(3), F.lit("")), F.lit("00"))
    clock = (
        F.when(t.rlike(_CLOCK), F.concat(hour.cast("string"), F.lit(":"), part(2), F.lit(":"), seconds))
        .when(~t.rlike(_ANY_CLOCK), F.lit("00:00:00"))
    )
    day = parse_date(F.regexp_replace(t, _CLOCK, ""))
    return F.concat(day.cast("string"), F.lit(" "), clock).try_cast("timestamp_ntz")


def date_key(day: Column) -> Column:
    """yyyymmdd as an integer, by arithmetic on the date fields."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
