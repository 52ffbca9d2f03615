"""The four marts. Facts are aggregated to the join key before any join."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.money import exact_avg, exact_ratio, money
from ledgermill.operators.lookups import BROADCAST_BYTES, stored_bytes
from ledgermill.schemas import UNKNOWN_ID

# Thresholds and labels of the marts.
FEE_RATE = "0.015"
SCORE_TIERS = ((750, "EXCELLENT"), (700, "GOOD"), (600, "FAIR"), (300, "POOR"))
NO_SCORE_TIER = "UNSCORED"
RISK_TIERS = (
    (750, "1. EXCELLENT (750 - 850)"),
    (700, "2. GOOD (700 - 749)"),
    (600, "3. FAIR (600 - 699)"),
    (300, "4. POOR (300 - 599)"),
)
NO_RISK_TIER = "5. UNSCORED / GUEST"
BRANCH_LIMIT = 50


def _steps(score: Column, steps: tuple[tuple[int, str], ...], otherwise: str) -> Column:
    out = F
    for floor, label in steps:
        out = out.when(score >= floor, label)
    return out.otherwise(otherwise)


def credit_tier(score: Column) -> Column:
    return _steps(score, SCORE_TIERS, NO_SCORE_TIER)


def risk_tier(score: Column) -> Column:
    return _steps(score, RISK_TIERS, NO_RISK_TIER)


def customer_segment(balance: Column, spend: Column) -> Column:
    # The bounds of the segments.
    return (
        F.when((balance >= 100000) | (spend >= 50000), "PLATINUM_VIP")
        .when((balance >= 30000) | (spend >= 15000), "GOLD_AFFLUENT")
        .when(balance >= 5000, "SILVER_STANDARD")
        .otherwise("BRONZE_RETAIL")
    )


def _or_zero(column: str) -> Column:
    return F.coalesce(column, F.lit(0)).alias(column)


def _money_or_zero(column: str) -> Column:
    return money(F.coalesce(column, F.lit(0))).alias(column)


def _stamped(rows: DataFrame, run_ts: datetime | None) -> DataFrame:
    if run_ts is None:
        return rows
    return rows.withColumn("mart_updated_at", F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz"))


def _known_customers(fact: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Fact rows of real customers; without an UNKNOWN member nothing passes."""
    unknown = dim_customer.filter(F.col("customer_id") == UNKNOWN_ID).agg(F.max("customer_key"))
    return fact.filter(F.col("customer_key") != unknown.scalar())


SUMS = {"sums_by_customer": ("customer_key",), "sums_by_day": ("date_key",), "sums_by_merchant": ("merchant_key",)}
"""Stored partial sums of transactions the marts may be worked out from, and their keys."""


def sums(rows: DataFrame, *keys: str) -> DataFrame:
    """Count, sum, bounds and last date per key: of transactions, or of such sums stored load by load.

    All of them merge exactly, so sums of the sums of several loads are those
    of one load of all their rows.
    """
    if "amount_usd" in rows.columns:
        amount = F.col("amount_usd")
        n, valued, total, least, most, last = F.count("*"), F.count(amount), F.sum(amount), F.min(amount), F.max(amount), F.max("transaction_date")
    else:
        n, valued, total, least, most, last = F.sum("n"), F.sum("valued"), F.sum("amount"), F.min("least"), F.max("most"), F.max("last")
    return rows.groupBy(*keys).agg(
        n.alias("n"), valued.alias("valued"), money(total).alias("amount"), least.alias("least"), most.alias("most"), last.alias("last")
    )


def customer_accounts(stg_accounts: DataFrame, dim_account: DataFrame) -> DataFrame:
    return (
        stg_accounts.select("account_id", "customer_id")
        .join(dim_account.select("account_id", "account_key", "balance_usd"), "account_id")
        .groupBy("customer_id")
        .agg(
            F.count("account_key").alias("total_accounts"),
            money(F.sum("balance_usd")).alias("total_balance_usd"),
        )
    )


def customer_spending(fact_transactions: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Per known customer, from transactions or from :func:`sums` of them."""
    return sums(_known_customers(fact_transactions, dim_customer), "customer_key").select(
        "customer_key",
        F.col("n").alias("total_transactions"),
        F.col("amount").alias("total_spend_usd"),
        money(exact_ratio(F.col("amount"), F.col("valued"))).alias("avg_txn_amount_usd"),
        F.col("last").alias("last_transaction_date"),
    )


def customer_loans(fact_loans: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return (
        _known_customers(fact_loans, dim_customer)
        .groupBy("customer_key")
        .agg(
            F.count("*").alias("active_loans_count"),
            money(F.sum("loan_amount")).alias("total_loan_debt_usd"),
            money(exact_avg(F.col("interest_rate"))).alias("avg_loan_interest_rate"),
        )
    )


def customer_360(
    dim_customer: DataFrame,
    dim_account: DataFrame,
    stg_accounts: DataFrame,
    fact_transactions: DataFrame,
    fact_loans: DataFrame,
    run_ts: datetime | None = None,
) -> DataFrame:
    rows = (
        dim_customer.filter(F.col("customer_id") != UNKNOWN_ID)
        .join(customer_accounts(stg_accounts, dim_account), "customer_id", "left")
        .join(customer_spending(fact_transactions, dim_customer), "customer_key", "left")
        .join(customer_loans(fact_loans, dim_customer), "customer_key", "left")
        .select(
            "customer_key",
            "customer_id",
            "full_name",
            "email",
            "city",
            "credit_score",
            credit_tier(F.col("credit_score")).alias("credit_tier"),
            _or_zero("total_accounts"),
            _money_or_zero("total_balance_usd"),
            _or_zero("total_transactions"),
            _money_or_zero("total_spend_usd"),
            _money_or_zero("avg_txn_amount_usd"),
            "last_transaction_date",
            _or_zero("active_loans_count"),
            _money_or_zero("total_loan_debt_usd"),
            _money_or_zero("avg_loan_interest_rate"),
        )
    )
    segment = customer_segment(F.col("total_balance_usd"), F.col("total_spend_usd"))
    return _stamped(rows.withColumn("customer_segment", segment), run_ts)


def _per_day(fact: DataFrame, *keys: str) -> DataFrame:
    return sums(fact, *keys).select(
        *keys,
        F.col("n").alias("daily_transactions_count"),
        F.col("amount").alias("daily_transaction_volume_usd"),
        money(exact_ratio(F.col("amount"), F.col("valued"))).alias("avg_ticket_size_usd"),
    )


_DAY_COLUMNS = ("year", "quarter", "month", "month_name", "full_date", "is_weekend")
_BRANCH_COLUMNS = ("branch_key", "branch_id", "branch_name", "manager_name")


def _branch_day_columns() -> list:
    return [
        *_DAY_COLUMNS,
        *_BRANCH_COLUMNS,
        _or_zero("daily_transactions_count"),
        _money_or_zero("daily_transaction_volume_usd"),
        _money_or_zero("avg_ticket_size_usd"),
    ]


def first_branches(dim_branch: DataFrame, limit: int = BRANCH_LIMIT) -> DataFrame:
    """The first ``limit`` real branches by id."""
    return dim_branch.filter(F.col("branch_id") != UNKNOWN_ID).orderBy("branch_id").limit(limit)


def _for_each_branch(days: DataFrame, branches: DataFrame) -> DataFrame:
    """Each day once per branch of a bounded list, as the mart defines.

    The outer form spares a test of the list's size, which would work it out again.
    """
    listed = branches.agg(F.collect_list(F.struct(*_BRANCH_COLUMNS))).scalar()
    return days.select(*days.columns, F.explode_outer(listed).alias("_branch")).filter("_branch is not null").select(
        *days.columns, "_branch.*"
    )


def daily_branch_performance(
    dim_date: DataFrame,
    dim_branch: DataFrame,
    fact_transactions: DataFrame,
    limit: int = BRANCH_LIMIT,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Day by branch, where every branch shows the whole bank's day.

    Facts match on the date alone, so they shrink to one row per day before
    the days are repeated for at most ``limit`` branches.
    """
    days = dim_date.join(_per_day(fact_transactions, "date_key"), "date_key", "left")
    rows = _for_each_branch(days, first_branches(dim_branch, limit))
    return _stamped(rows.select(*_branch_day_columns()), run_ts)


def daily_branch_by_branch(
    dim_date: DataFrame,
    dim_branch: DataFrame,
    fact_transactions: DataFrame,
    run_ts: datetime | None = None,
) -> DataFrame:
    """Day by branch with each branch's own transactions: all branches, the UNKNOWN one included.

    Every day with every branch is what the mart holds; branches are sent to
    the days' tasks if they are measured small.
    """
    branches = dim_branch.select(*_BRANCH_COLUMNS)
    grid = dim_date.crossJoin(F.broadcast(branches) if stored_bytes(branches) <= BROADCAST_BYTES else branches)
    own = _per_day(fact_transactions, "date_key", "branch_key")
    rows = grid.join(own, ["date_key", "branch_key"], "left")
    return _stamped(rows.select(*_branch_day_columns()), run_ts)


def merchant_analytics(
    dim_merchant: DataFrame, fact_transactions: DataFrame, run_ts: datetime | None = None
) -> DataFrame:
    sales = sums(fact_transactions, "merchant_key").select(
        "merchant_key",
        F.col("n").alias("total_transactions"),
        F.col("amount").alias("total_sales_volume_usd"),
        money(exact_ratio(F.col("amount"), F.col("valued"))).alias("avg_order_value_usd"),
        money(F.col("least")).alias("min_txn_amount_usd"),
        money(F.col("most")).alias("max_txn_amount_usd"),
    )
    total = F.coalesce("total_sales_volume_usd", F.lit(0)).cast("decimal(25,2)")
    rows = dim_merchant.join(sales, "merchant_key", "left").select(
        "merchant_key",
        "merchant_id",
        "merchant_name",
        "city",
        _or_zero("total_transactions"),
        _money_or_zero("total_sales_volume_usd"),
        _money_or_zero("avg_order_value_usd"),
        _money_or_zero("min_txn_amount_usd"),
        _money_or_zero("max_txn_amount_usd"),
        money(F.round(total * F.lit(FEE_RATE).cast("decimal(4,3)"), 2)).alias("estimated_interchange_fee_usd"),
    )
    return _stamped(rows, run_ts)


def credit_risk_monitoring(
    fact_loans: DataFrame, dim_customer: DataFrame, run_ts: datetime | None = None
) -> DataFrame:
    """Loans by score tier. Loans shrink to one row per customer before the join,
    so a customer (or the UNKNOWN one) with very many loans is one row in it."""
    per_customer = fact_loans.groupBy("customer_key").agg(
        F.count("*").alias("n"),
        F.sum("loan_amount").cast("decimal(25,2)").alias("amount"),
        F.sum("interest_rate").cast("decimal(20,2)").alias("rate"),
        F.sum(F.col("loan_amount") * F.col("interest_rate")).cast("decimal(34,4)").alias("weighted"),
    )
    tiered = per_customer.join(
        dim_customer.select("customer_key", risk_tier(F.col("credit_score")).alias("credit_risk_tier")),
        "customer_key",
    )
    loans = F.sum("n")
    rows = tiered.groupBy("credit_risk_tier").agg(
        loans.alias("total_loans_originated"),
        money(F.sum("amount")).alias("total_loan_debt_usd"),
        money(exact_ratio(F.sum("amount"), loans)).alias("avg_loan_size_usd"),
        money(exact_ratio(F.sum("rate"), loans)).alias("avg_interest_rate_pct"),
        money(F.round(F.sum("weighted") / 100, 2)).alias("estimated_annual_interest_revenue_usd"),
    )
    return _stamped(rows, run_ts)
