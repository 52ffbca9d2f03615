from ledgermill.functions.dates import date_key, parse_date, parse_timestamp
from ledgermill.functions.money import exact_avg, number_or_fail, whole_or_fail
from ledgermill.functions.text import (
    blank_to_null,
    capitalise_words,
    missing_to_null,
    strip_whitespace,
    valid_email_or,
)

__all__ = [
    "blank_to_null",
    "capitalise_words",
    "date_key",
    "exact_avg",
    "missing_to_null",
    "number_or_fail",
    "parse_date",
    "parse_timestamp",
    "strip_whitespace",
    "valid_email_or",
    "whole_or_fail",
]
