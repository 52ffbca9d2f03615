"""Transaction and loan facts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import date_key
from ledgermill.operators.lookups import BROADCAST_BYTES, Held, absent_from, absent_from_buckets, held, lookup
from ledgermill.schemas import DIMENSIONS, UNKNOWN_ID

TRANSACTION_COLUMNS = (
    "transaction_id",
    "customer_key",
    "account_key",
    "card_key",
    "merchant_key",
    "branch_key",
    "date_key",
    "amount_usd",
    "transaction_date",
)
LOAN_COLUMNS = (
    "loan_id",
    "customer_key",
    "branch_key",
    "start_date_key",
    "loan_amount",
    "interest_rate",
    "start_date",
)


def valid_transactions(stg: DataFrame) -> DataFrame:
    return stg.filter(
        "transaction_id is not null and account_id is not null and merchant_id is not null"
        " and transaction_date is not null and amount_usd > 0"
    ).select("transaction_id", "account_id", "merchant_id", "amount_usd", "transaction_date")


def valid_loans(stg: DataFrame) -> DataFrame:
    return stg.filter(
        "loan_id is not null and customer_id is not null and start_date is not null"
        " and loan_amount > 0 and interest_rate >= 0"
    ).select("loan_id", "customer_id", "loan_amount", "interest_rate", "start_date")


def first_transactions(valid: DataFrame) -> DataFrame:
    """One row per transaction id: earliest, then smallest merchant, account and amount.

    Copies collapse inside each task before the shuffle, so an id repeated many
    times costs one row per task.
    """
    order = ("transaction_date", "merchant_id", "account_id", "amount_usd")
    first = valid.groupBy("transaction_id").agg(F.min(F.struct(*order)).alias("_row"))
    return first.select("transaction_id", *[F.col(f"_row.{c}").alias(c) for c in order]).select(*valid.columns)


def first_loans(valid: DataFrame) -> DataFrame:
    order = ("start_date", "customer_id", "loan_amount", "interest_rate")
    first = valid.groupBy("loan_id").agg(F.min(F.struct(*order)).alias("_row"))
    return first.select("loan_id", *[F.col(f"_row.{c}").alias(c) for c in order]).select(*valid.columns)


def latest_cards(stg_cards: DataFrame) -> DataFrame:
    """One card per account: no expiry first, then latest expiry, then highest card id.

    A card without an expiry date counts as the latest one.
    """
    expiry = F.col("expiration_date")
    rank = F.struct(expiry.isNull().alias("open_ended"), expiry, F.col("card_id"))
    return (
        stg_cards.filter("account_id is not null")
        .groupBy("account_id")
        .agg(F.max(rank).alias("_best"))
        .select("account_id", F.col("_best.card_id").alias("card_id"))
    )


def account_owners(stg_accounts: DataFrame) -> DataFrame:
    """The customer of each account; a repeated account id keeps its smallest customer."""
    return (
        stg_accounts.filter("account_id is not null")
        .groupBy("account_id")
        .agg(F.min("customer_id").alias("customer_id"))
    )


def account_keys(
    stg_accounts: DataFrame,
    stg_cards: DataFrame,
    dim_customer: DataFrame,
    dim_account: DataFrame,
    dim_card: DataFrame,
    owners: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Everything an account id resolves to: customer, account and card keys.

    Worked out once per account, so that the far larger transactions need one
    join on account_id instead of five. ``owners`` may hold account links kept
    from earlier batches; links of this batch win over them.
    """
    links = account_owners(stg_accounts)
    if owners is not None:
        kept = owners.select("account_id", F.col("customer_id").alias("_kept"))
        links = links.join(kept, "account_id", "full_outer").select(
            "account_id", F.coalesce("customer_id", "_kept").alias("customer_id")
        )
    known = dim_customer.select("customer_id", "customer_key")
    customers = (
        lookup(links, known, "customer_id", "account_id", broadcast_bytes=broadcast_bytes)
        .filter("customer_key is not null")
        .select("account_id", "customer_key")
    )
    cards = latest_cards(stg_cards).join(dim_card.select("card_id", "card_key"), "card_id").select(
        "account_id", "card_key"
    )
    accounts = dim_account.select("account_id", "account_key")
    return accounts.join(customers, "account_id", "full_outer").join(cards, "account_id", "full_outer")


def unknown_keys(dims: dict[str, DataFrame]) -> DataFrame:
    """One row with the UNKNOWN surrogate key of each given dimension (null if there is none)."""
    spark = next(iter(dims.values())).sparkSession
    keys = [unknown_key(dims, name).alias(f"unknown_{DIMENSIONS[name].surrogate_key}") for name in dims]
    return spark.range(1, numPartitions=1).select(*keys)


def unknown_key(dims: dict[str, DataFrame], name: str) -> Column:
    """The UNKNOWN surrogate key of one dimension, as a scalar subquery."""
    spec = DIMENSIONS[name]
    return dims[name].filter(F.col(spec.natural_key) == UNKNOWN_ID).agg(F.max(spec.surrogate_key)).scalar()


@dataclass(frozen=True)
class HeldTables:
    """What many batches of transactions meet, measured and dealt out once (:func:`held_tables`)."""

    accounts: Held
    merchants: Held
    unknown: Mapping[str, Column]

    def release(self) -> None:
        self.accounts.release()
        self.merchants.release()


def held_tables(
    keys_by_account: DataFrame, dims: Mapping[str, DataFrame], broadcast_bytes: int = BROADCAST_BYTES
) -> HeldTables:
    """Prepare the tables of :func:`build_transactions` for one batch after another.

    Without it each batch measures, shuffles and sorts them and looks for the
    UNKNOWN keys anew, however few rows it has.
    """
    members = {name: dims[name] for name in DIMENSIONS}
    keys = unknown_keys(members)
    found = keys.first()
    unknown = {name: F.lit(found[f.name]).cast(f.dataType) for name, f in zip(members, keys.schema.fields, strict=True)}
    merchants = dims["dim_merchant"].select("merchant_id", "merchant_key")
    return HeldTables(
        held(keys_by_account, "account_id", broadcast_bytes), held(merchants, "merchant_id", broadcast_bytes), unknown
    )


def outside_calendar(keyed: DataFrame, dim_date: DataFrame, key: str) -> DataFrame:
    """Rows whose date key the calendar does not hold."""
    days = F.broadcast(dim_date.select(F.col("date_key").alias(key)))
    return keyed.join(days, key, "left_anti")


def inside_calendar(keyed: DataFrame, dim_date: DataFrame, key: str, on_missing: str = "raise") -> DataFrame:
    """Hold date keys to the calendar: fail the batch, or keep what :func:`outside_calendar` does not set aside.

    The calendar has one row per day, which bounds the broadcast. ``keep``
    leaves the rows as they are, for a caller that divides them itself.
    """
    days = F.broadcast(dim_date.select(F.col("date_key").alias(key), F.lit(True).alias("_known")))
    if on_missing == "keep":
        return keyed
    if on_missing == "quarantine":
        return keyed.join(days.drop("_known"), key, "left_semi").select(*keyed.columns)
    if on_missing != "raise":
        raise ValueError(f"on_missing: {on_missing!r}")
    message = F.concat(F.lit(f"{key} not in dim_date: "), F.col(key).cast("string"))
    checked = F.when(F.col("_known").isNull(), F.raise_error(message)).otherwise(F.col(key))
    return keyed.join(days, key, "left").withColumn(key, checked).select(*keyed.columns)


def build_transactions(
    stg_transactions: DataFrame,
    keys_by_account: DataFrame,
    dims: dict[str, DataFrame],
    on_missing_date: str = "raise",
    broadcast_bytes: int = BROADCAST_BYTES,
    tables: HeldTables | None = None,
) -> DataFrame:
    """Enriched transactions, one row per id; lookups that find nothing give the UNKNOWN key.

    ``keys_by_account`` is the stored result of :func:`account_keys`. Merchants
    are fewer than accounts and come first, so that rows which are shuffled to
    their account's keys carry a number in place of the merchant's id.
    ``tables`` may hold both, and the UNKNOWN keys, for batch after batch.
    """
    rows = first_transactions(valid_transactions(stg_transactions))
    merchants = tables.merchants if tables else dims["dim_merchant"].select("merchant_id", "merchant_key")
    accounts = tables.accounts if tables else keys_by_account
    rows = lookup(rows, merchants, "merchant_id", "transaction_id", stg_transactions, broadcast_bytes).drop("merchant_id")
    rows = lookup(rows, accounts, "account_id", "transaction_id", stg_transactions, broadcast_bytes)
    unknown = (lambda name: tables.unknown[name]) if tables else (lambda name: unknown_key(dims, name))
    keyed = rows.select(
        "transaction_id",
        F.coalesce("customer_key", unknown("dim_customer")).alias("customer_key"),
        F.coalesce("account_key", unknown("dim_account")).alias("account_key"),
        F.coalesce("card_key", unknown("dim_card")).alias("card_key"),
        F.coalesce("merchant_key", unknown("dim_merchant")).alias("merchant_key"),
        unknown("dim_branch").alias("branch_key"),
        date_key(F.col("transaction_date").cast("date")).alias("date_key"),
        "amount_usd",
        "transaction_date",
    )
    return inside_calendar(keyed, dims["dim_date"], "date_key", on_missing_date)


def build_loans(
    stg_loans: DataFrame,
    dims: dict[str, DataFrame],
    on_missing_date: str = "raise",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    rows = first_loans(valid_loans(stg_loans))
    customers = dims["dim_customer"].select("customer_id", "customer_key")
    rows = lookup(rows, customers, "customer_id", "loan_id", stg_loans, broadcast_bytes)
    keyed = rows.select(
        "loan_id",
        F.coalesce("customer_key", unknown_key(dims, "dim_customer")).alias("customer_key"),
        unknown_key(dims, "dim_branch").alias("branch_key"),
        date_key(F.col("start_date")).alias("start_date_key"),
        "loan_amount",
        "interest_rate",
        "start_date",
    )
    return inside_calendar(keyed, dims["dim_date"], "start_date_key", on_missing_date)


def one_of_each(batch: DataFrame, id_col: str) -> DataFrame:
    """The smallest row of each id, copies collapsed before the shuffle."""
    rest = [c for c in batch.columns if c != id_col]
    one = batch.groupBy(id_col).agg(F.min(F.struct(*rest)).alias("_row"))
    return one.select(id_col, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*batch.columns)


def insert_if_absent(
    batch: DataFrame, existing: DataFrame | None, id_col: str, buckets: int | None = None
) -> DataFrame:
    """The rows of a batch with one row per id that a load adds to the stored fact.

    ``existing`` holds the ids loaded before: the fact itself, or with
    ``buckets`` its ids in folders by hash, of which only the batch's are read.
    """
    if existing is None:
        return batch
    return absent_from_buckets(batch, existing, id_col, buckets) if buckets else absent_from(batch, existing, id_col)
