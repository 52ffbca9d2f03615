"""Dimension cleaning, unknown members, type-1 upsert and the calendar."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.functions import blank_to_null, capitalise_words, date_key, valid_email_or
from ledgermill.functions.text import in_set_or
from ledgermill.operators.keys import dense_keys, max_key
from ledgermill.schemas import DIMENSIONS, MONEY, UNKNOWN_ID

# Accepted codes, score range and the texts that stand in for bad input.
ACCOUNT_TYPES = ("CHECKING", "SAVINGS", "INVESTMENT", "CREDIT")
CARD_TYPES = ("DEBIT", "CREDIT", "PREPAID")
SCORE_RANGE = (300, 850)
INVALID_SCORE = -1
INVALID_EMAIL = "invalid-email@bank.internal"
UNKNOWN_CITY = "Unknown City"

# The UNKNOWN member of each dimension.
UNKNOWN_MEMBERS: dict[str, dict[str, object]] = {
    "dim_customer": {
        "customer_id": UNKNOWN_ID,
        "first_name": "External",
        "last_name": "Customer",
        "full_name": "External / Guest Customer",
        "email": "external-guest@bank.internal",
        "city": UNKNOWN_CITY,
        "credit_score": INVALID_SCORE,
        "created_at": date(1900, 1, 1),
    },
    "dim_account": {
        "account_id": UNKNOWN_ID,
        "account_type": "EXTERNAL_ACCOUNT",
        "balance_usd": 0,
        "open_date": date(1900, 1, 1),
    },
    "dim_card": {
        "card_id": UNKNOWN_ID,
        "card_type": "EXTERNAL_CARD",
        "expiration_date": date(1900, 1, 1),
    },
    "dim_merchant": {
        "merchant_id": UNKNOWN_ID,
        "merchant_name": "Unregistered / External Merchant",
        "city": UNKNOWN_CITY,
    },
    "dim_branch": {
        "branch_id": UNKNOWN_ID,
        "branch_name": "General / Online Branch",
        "manager_name": "Unassigned",
    },
}


def _known_id(rows: DataFrame, id_col: str) -> DataFrame:
    return rows.filter(F.trim(id_col) != "")


def _name(column: str, default: str) -> Column:
    return F.coalesce(capitalise_words(blank_to_null(F.col(column))), F.lit(default))


def clean_customers(stg: DataFrame, run_date: date) -> DataFrame:
    score = F.col("credit_score")
    named = _known_id(stg, "customer_id").select(
        F.trim("customer_id").alias("customer_id"),
        _name("first_name", "Unknown").alias("first_name"),
        _name("last_name", "Customer").alias("last_name"),
        valid_email_or(F.col("email"), INVALID_EMAIL).alias("email"),
        _name("city", UNKNOWN_CITY).alias("city"),
        F.when(score.between(*SCORE_RANGE), score).otherwise(INVALID_SCORE).alias("credit_score"),
        F.coalesce("created_at", F.lit(run_date)).alias("created_at"),
    )
    return named.select(
        "customer_id",
        "first_name",
        "last_name",
        F.concat_ws(" ", "first_name", "last_name").alias("full_name"),
        "email",
        "city",
        "credit_score",
        "created_at",
    )


def clean_accounts(stg: DataFrame, run_date: date) -> DataFrame:
    return _known_id(stg, "account_id").select(
        F.trim("account_id").alias("account_id"),
        in_set_or(F.col("account_type"), ACCOUNT_TYPES, "OTHER").alias("account_type"),
        F.coalesce("balance_usd", F.lit(0).cast(MONEY)).alias("balance_usd"),
        F.coalesce("open_date", F.lit(run_date)).alias("open_date"),
    )


def clean_cards(stg: DataFrame, run_date: date | None = None) -> DataFrame:
    return _known_id(stg, "card_id").select(
        F.trim("card_id").alias("card_id"),
        in_set_or(F.col("card_type"), CARD_TYPES, "STANDARD").alias("card_type"),
        "expiration_date",
    )


def clean_merchants(stg: DataFrame, run_date: date | None = None) -> DataFrame:
    return _known_id(stg, "merchant_id").select(
        F.trim("merchant_id").alias("merchant_id"),
        F.coalesce(blank_to_null(F.col("merchant_name")), F.lit("Unknown Merchant")).alias("merchant_name"),
        _name("city", UNKNOWN_CITY).alias("city"),
    )


def clean_branches(stg: DataFrame, run_date: date | None = None) -> DataFrame:
    return _known_id(stg, "branch_id").select(
        F.trim("branch_id").alias("branch_id"),
        F.coalesce(blank_to_null(F.col("branch_name")), F.lit("General Branch")).alias("branch_name"),
        _name("manager_name", "Unassigned").alias("manager_name"),
    )


CLEANERS = {
    "dim_customer": clean_customers,
    "dim_account": clean_accounts,
    "dim_card": clean_cards,
    "dim_merchant": clean_merchants,
    "dim_branch": clean_branches,
}


def duplicate_ids(members: DataFrame, id_col: str) -> DataFrame:
    """Natural keys that occur more than once, with their counts."""
    return members.groupBy(id_col).count().filter("count > 1")


def rejected_members(members: DataFrame, id_col: str) -> DataFrame:
    """The rows :func:`one_per_id` does not keep, equal ones as one row with their number as ``copies``.

    Equal rows collapse before the shuffle. Kept rows and copies add up to the batch.
    """
    rest = F.struct(*[c for c in members.columns if c != id_col])
    rows = members.groupBy(*members.columns).agg(F.count("*").alias("copies"))
    kept = rows.groupBy(id_col).agg(F.min(rest).alias("_kept"), F.sum("copies").alias("_n")).filter("_n > 1")
    left = rows.join(kept, id_col).withColumn("copies", F.col("copies") - rest.eqNullSafe(F.col("_kept")).cast("int"))
    return left.filter("copies > 0").select(*members.columns, "copies")


def one_per_id(members: DataFrame, id_col: str, on_duplicate: str = "raise", spare: DataFrame | None = None) -> DataFrame:
    """One row per natural key.

    ``raise`` fails the job on a repeated key; ``keep_first`` and ``quarantine``
    keep the smallest row in column order (:func:`rejected_members` has the
    others). A repeated key collapses before the shuffle.
    ``spare`` rows stand in for ids the members lack (column ``_spare`` tells).
    """
    rest = [c for c in members.columns if c != id_col]
    rows = members.withColumn("_spare", F.lit(False))
    if spare is not None:
        rows = rows.unionByName(spare.withColumn("_spare", F.lit(True)))
    one = rows.groupBy(id_col).agg(
        F.min(F.struct("_spare", *rest)).alias("_row"), F.count_if(~F.col("_spare")).alias("_n")
    )
    if on_duplicate == "raise":
        message = F.concat(F.lit(f"duplicate {id_col} in one batch: "), F.col(id_col))
        kept_id = F.when(F.col("_n") > 1, F.raise_error(message)).otherwise(F.col(id_col)).alias(id_col)
    elif on_duplicate in ("keep_first", "quarantine"):
        kept_id = F.col(id_col)
    else:
        raise ValueError(f"on_duplicate: {on_duplicate!r}")
    return one.select(kept_id, *[F.col(f"_row.{c}").alias(c) for c in ("_spare", *rest)]).select(
        *members.columns, "_spare"
    )


def unknown_member(spark: SparkSession, dim: str, like: DataFrame) -> DataFrame:
    """The UNKNOWN row of a dimension, typed as the given members."""
    values = UNKNOWN_MEMBERS[dim]
    kinds = {f.name: f.dataType for f in like.schema.fields}
    one = spark.range(1, numPartitions=1)
    return one.select([F.lit(values[c]).cast(kinds[c]).alias(c) for c in values])


def upsert_dimension(
    dim: str,
    batch: DataFrame,
    existing: DataFrame | None = None,
    on_duplicate: str = "raise",
    store: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Type-1 upsert of cleaned members into a dimension, UNKNOWN row included.

    Known members keep their surrogate key and their insert-only columns; new
    members are numbered after the highest existing key. A cleaned member whose
    id is UNKNOWN itself overwrites the stand-in row, as an upsert would.
    ``store`` may write down the numbers of new members (few, in an incremental
    batch), which the one outer join of old and new rows then looks up.
    """
    spec = DIMENSIONS[dim]
    nk, sk = spec.natural_key, spec.surrogate_key
    new = one_per_id(batch, nk, on_duplicate, unknown_member(batch.sparkSession, dim, batch))
    at_most = batch.count() + 1
    if existing is None:
        return dense_keys(new.drop("_spare"), nk, sk, at_most=at_most)

    unseen = new.select(nk).join(existing.select(nk), nk, "left_anti")
    numbers = store(dense_keys(unseen, nk, sk, after=max_key(existing, sk), at_most=at_most)).select(nk, F.col(sk).alias("_number"))
    old = existing.select(nk, sk, F.struct(*spec.attributes).alias("_old"))
    fresh = new.select(nk, F.struct(*spec.attributes).alias("_new"), "_spare")
    both = old.join(fresh, nk, "full_outer").join(numbers, nk, "left")
    update = F.col("_new").isNotNull() & ~F.col("_spare")

    def merged(column: str) -> Column:
        from_new = F.col("_old").isNull() if column in spec.insert_only else F.col("_old").isNull() | update
        return F.when(from_new, F.col(f"_new.{column}")).otherwise(F.col(f"_old.{column}")).alias(column)

    key = F.coalesce(sk, "_number").alias(sk)
    return both.select(key, nk, *[merged(c) for c in spec.attributes]).select(sk, *batch.columns)


def build_dimension(
    dim: str,
    stg: DataFrame,
    run_date: date,
    existing: DataFrame | None = None,
    on_duplicate: str = "raise",
    store: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    return upsert_dimension(dim, CLEANERS[dim](stg, run_date), existing, on_duplicate, store)


def calendar(days: DataFrame) -> DataFrame:
    """Calendar attributes of a one-column frame of dates (``full_date``)."""
    d = F.col("full_date")
    iso_day = F.weekday(d) + 1
    return days.select(
        date_key(d).alias("date_key"),
        d,
        iso_day.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
        iso_day.isin(6, 7).alias("is_weekend"),
    )


def build_dim_date(
    spark: SparkSession, start: date = date(2018, 1, 1), end: date = date(2030, 12, 31)
) -> DataFrame:
    days = F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day")))
    return calendar(spark.range(1).select(days.alias("full_date")))


def missing_dates(dim_date: DataFrame, dates: DataFrame) -> DataFrame:
    """Calendar rows for the dates (one column) that ``dim_date`` does not hold yet."""
    days = dates.select(F.col(dates.columns[0]).cast("date").alias("full_date"))
    needed = days.filter("full_date is not null").distinct()
    return calendar(needed.join(dim_date.select("full_date"), "full_date", "left_anti"))


def ensure_dates(dim_date: DataFrame, dates: DataFrame) -> DataFrame:
    return dim_date.unionByName(missing_dates(dim_date, dates))
