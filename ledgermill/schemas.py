"""Declared table layouts: raw columns, staging types, constraints and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(15, 2)
RATE = T.DecimalType(6, 2)

UNKNOWN_ID = "UNKNOWN"


@dataclass(frozen=True)
class Column:
    name: str
    type: T.DataType
    max_length: int | None = None


def _text(name: str, length: int) -> Column:
    return Column(name, T.StringType(), length)


def _date(name: str) -> Column:
    return Column(name, T.DateType())


# Column order, types and text widths of the seven source tables.
STAGING: dict[str, tuple[Column, ...]] = {
    "customers": (
        _text("customer_id", 50),
        _text("first_name", 100),
        _text("last_name", 100),
        _text("email", 150),
        _text("city", 100),
        Column("credit_score", T.IntegerType()),
        _date("created_at"),
    ),
    "accounts": (
        _text("account_id", 50),
        _text("customer_id", 50),
        _text("account_type", 50),
        Column("balance_usd", MONEY),
        _date("open_date"),
    ),
    "cards": (
        _text("card_id", 50),
        _text("account_id", 50),
        _text("card_type", 50),
        _date("expiration_date"),
    ),
    "merchants": (
        _text("merchant_id", 50),
        _text("merchant_name", 150),
        _text("city", 100),
    ),
    "branches": (
        _text("branch_id", 50),
        _text("branch_name", 150),
        _text("manager_name", 100),
    ),
    "loans": (
        _text("loan_id", 50),
        _text("customer_id", 50),
        Column("loan_amount", MONEY),
        Column("interest_rate", RATE),
        _date("start_date"),
    ),
    "transactions": (
        _text("transaction_id", 100),
        _text("account_id", 50),
        _text("merchant_id", 50),
        Column("amount_usd", MONEY),
        Column("transaction_date", T.TimestampNTZType()),
    ),
}


@dataclass(frozen=True)
class Dimension:
    """Natural key, surrogate key and what a type-1 upsert may overwrite."""

    source: str
    natural_key: str
    surrogate_key: str
    updated: tuple[str, ...]
    insert_only: tuple[str, ...] = ()
    widths: tuple[tuple[str, int], ...] = ()

    @property
    def attributes(self) -> tuple[str, ...]:
        return self.updated + self.insert_only


# Warehouse dimensions, their keys, update lists and text widths.
DIMENSIONS: dict[str, Dimension] = {
    "dim_customer": Dimension(
        "customers",
        "customer_id",
        "customer_key",
        ("first_name", "last_name", "full_name", "email", "city", "credit_score"),
        ("created_at",),
        (
            ("customer_id", 50),
            ("first_name", 100),
            ("last_name", 100),
            ("full_name", 200),
            ("email", 150),
            ("city", 100),
        ),
    ),
    "dim_account": Dimension(
        "accounts",
        "account_id",
        "account_key",
        ("account_type", "balance_usd", "open_date"),
        widths=(("account_id", 50), ("account_type", 50)),
    ),
    "dim_card": Dimension(
        "cards",
        "card_id",
        "card_key",
        ("card_type", "expiration_date"),
        widths=(("card_id", 50), ("card_type", 50)),
    ),
    "dim_merchant": Dimension(
        "merchants",
        "merchant_id",
        "merchant_key",
        ("merchant_name", "city"),
        widths=(("merchant_id", 50), ("merchant_name", 150), ("city", 100)),
    ),
    "dim_branch": Dimension(
        "branches",
        "branch_id",
        "branch_key",
        ("branch_name", "manager_name"),
        widths=(("branch_id", 50), ("branch_name", 150), ("manager_name", 100)),
    ),
}

PRIMARY_KEYS: dict[str, str] = {
    "dim_customer": "customer_key",
    "dim_account": "account_key",
    "dim_card": "card_key",
    "dim_merchant": "merchant_key",
    "dim_branch": "branch_key",
    "dim_date": "date_key",
    "fact_transactions": "transaction_key",
    "fact_loans": "loan_key",
}

FACT_NATURAL_KEYS: dict[str, str] = {
    "fact_transactions": "transaction_id",
    "fact_loans": "loan_id",
}

# fact -> ((foreign key, dimension, dimension key), ...)
FOREIGN_KEYS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "fact_transactions": (
        ("customer_key", "dim_customer", "customer_key"),
        ("account_key", "dim_account", "account_key"),
        ("card_key", "dim_card", "card_key"),
        ("merchant_key", "dim_merchant", "merchant_key"),
        ("branch_key", "dim_branch", "branch_key"),
        ("date_key", "dim_date", "date_key"),
    ),
    "fact_loans": (
        ("customer_key", "dim_customer", "customer_key"),
        ("branch_key", "dim_branch", "branch_key"),
        ("start_date_key", "dim_date", "date_key"),
    ),
}

MARTS = (
    "customer_360",
    "daily_branch_performance",
    "merchant_analytics",
    "credit_risk_monitoring",
)

# Smallest accepted row counts of the full-size dataset.
MIN_ROWS_WAREHOUSE: dict[str, int] = {
    "dim_date": 4000,
    "dim_customer": 50000,
    "dim_account": 75000,
    "dim_card": 100000,
    "dim_merchant": 5000,
    "dim_branch": 500,
    "fact_transactions": 1000000,
    "fact_loans": 30000,
}
MIN_ROWS_MARTS: dict[str, int] = {
    "customer_360": 50000,
    "daily_branch_performance": 200000,
    "merchant_analytics": 5000,
    "credit_risk_monitoring": 4,
}


def staging_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.type) for c in STAGING[table]])


def raw_schema(table: str) -> T.StructType:
    """All-text layout of a raw CSV; typing happens in the staging clean."""
    return T.StructType([T.StructField(c.name, T.StringType()) for c in STAGING[table]])
