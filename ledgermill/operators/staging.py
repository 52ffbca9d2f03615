"""Raw text to typed staging rows: projections only, no shuffle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill import schemas
from ledgermill.functions import (
    missing_to_null,
    number_or_fail,
    parse_date,
    parse_timestamp,
    strip_whitespace,
    whole_or_fail,
)


def clean_text(text: Column) -> Column:
    """Missing markers become null, everything else loses its outer whitespace."""
    return strip_whitespace(missing_to_null(text))


def _typed(column: schemas.Column, check_width: bool) -> Column:
    text = F.col(column.name)
    if isinstance(column.type, T.DecimalType):
        value = number_or_fail(text, column.type, column.name)
    elif isinstance(column.type, T.IntegerType):
        value = whole_or_fail(text, column.name)
    elif isinstance(column.type, T.DateType):
        value = parse_date(text)
    elif isinstance(column.type, T.TimestampNTZType):
        value = parse_timestamp(text)
    elif check_width:
        too_long = F.length(text) > column.max_length
        message = f"{column.name}: text longer than {column.max_length}"
        value = F.when(too_long, F.raise_error(F.lit(message))).otherwise(text)
    else:
        value = text
    return value.alias(column.name)


def clean_staging(raw: DataFrame, table: str, *, check_width: bool = True) -> DataFrame:
    """Type one raw table.

    Unreadable dates become null; unreadable numbers and over-long texts fail
    the batch, as they would on load into a declared table. Texts are cleaned
    in a step of their own: typing looks at one several times.
    """
    cleaned = raw.select([clean_text(F.col(c.name)).alias(c.name) for c in schemas.STAGING[table]])
    return cleaned.select([_typed(c, check_width) for c in schemas.STAGING[table]])


def with_loaded_at(rows: DataFrame, run_ts: datetime) -> DataFrame:
    return rows.withColumn("loaded_at", F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz"))
