"""Text rules, all as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cell texts a CSV reader takes for "no value".
MISSING_MARKERS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Fixed value: shape of an accepted e-mail address (matched on lower-cased text).
EMAIL_PATTERN = r"\A[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}\z"

# Characters that count as whitespace (ASCII, then the other Unicode spaces).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_WORDS_AND_GAPS = r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"


def strip_whitespace(text: Column) -> Column:
    """Drop leading and trailing whitespace of any kind (``trim`` drops spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def missing_to_null(text: Column) -> Column:
    return F.when(text.isin(*MISSING_MARKERS), None).otherwise(text)


def blank_to_null(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed != "", trimmed)


def capitalise_words(text: Column) -> Column:
    """Upper-case the first letter after every non-alphanumeric, lower-case the rest.

    Spark's ``initcap`` starts words at spaces only; here ``o'brien`` gives
    ``O'Brien`` and ``mary-jane`` gives ``Mary-Jane``.
    """
    pieces = F.regexp_extract_all(F.lower(text), F.lit(_WORDS_AND_GAPS), F.lit(0))
    return F.array_join(
        F.transform(pieces, lambda w: F.concat(F.upper(F.substr(w, F.lit(1), F.lit(1))), F.substr(w, F.lit(2)))),
        "",
    )


def valid_email_or(email: Column, default: str) -> Column:
    address = F.lower(F.trim(email))
    return F.when(address.rlike(EMAIL_PATTERN), address).otherwise(default)


def in_set_or(text: Column, allowed: tuple[str, ...], default: str) -> Column:
    code = F.upper(F.trim(text))
    return F.when(code.isin(*allowed), code).otherwise(default)
