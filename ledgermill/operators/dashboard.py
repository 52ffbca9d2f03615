"""Aggregates over the marts behind the executive dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.money import money
from ledgermill.schemas import UNKNOWN_ID

# The excluded display name, labels and row limits of the dashboard.
EXCLUDED_MERCHANT = "External Guest Merchant"
WEEKEND_LABELS = ("Cuối tuần", "Ngày thường")
SAMPLE_ROWS, SAMPLE_SEED = 1000, 42
SEARCH_ROWS = 500
TOP_BRANCHES, TOP_MERCHANTS, TOP_CITIES = 15, 10, 15
DETAIL_ROWS = 200

SEARCH_COLUMNS = (
    "customer_id",
    "full_name",
    "city",
    "credit_tier",
    "customer_segment",
    "total_accounts",
    "total_balance_usd",
    "total_spend_usd",
    "total_loan_debt_usd",
)
MERCHANT_COLUMNS = (
    "merchant_id",
    "merchant_name",
    "city",
    "total_transactions",
    "total_sales_volume_usd",
    "avg_order_value_usd",
    "estimated_interchange_fee_usd",
)


def filter_segment(c360: DataFrame, segments: list[str] | None = None) -> DataFrame:
    return c360.filter(F.col("customer_segment").isin(*segments)) if segments else c360


def filter_year(branch_days: DataFrame, year: int | None = None) -> DataFrame:
    return branch_days if year is None else branch_days.filter(F.col("year") == year)


def _total(column: str) -> Column:
    return money(F.coalesce(F.sum(column), F.lit(0))).alias(column)


def exec_kpis(c360: DataFrame, risk: DataFrame) -> DataFrame:
    customers = c360.agg(
        F.count("*").alias("total_customers"),
        _total("total_spend_usd"),
        _total("total_balance_usd"),
        _total("total_loan_debt_usd"),
    )
    revenue = risk.agg(_total("estimated_annual_interest_revenue_usd")).scalar()
    return customers.withColumn("estimated_annual_interest_revenue_usd", revenue)


def year_volume(branch_days: DataFrame) -> DataFrame:
    return branch_days.groupBy("year").agg(_total("daily_transaction_volume_usd")).orderBy("year")


def with_share(rows: DataFrame, value: str) -> DataFrame:
    """Percent of the total, which is a scalar subquery."""
    total = rows.agg(F.sum(value)).scalar()
    share = F.when(F.col("_total") != 0, F.round(F.col(value) * F.lit(100) / F.col("_total"), 2))
    return (
        rows.withColumn("_total", total)
        .withColumn("share_percent", F.coalesce(share.cast("double"), F.lit(0.0)))
        .drop("_total")
    )


def segment_count(c360: DataFrame) -> DataFrame:
    return with_share(c360.groupBy("customer_segment").agg(F.count("customer_id").alias("customers")), "customers")


def debt_by_tier(risk: DataFrame) -> DataFrame:
    return with_share(risk.groupBy("credit_risk_tier").agg(_total("total_loan_debt_usd")), "total_loan_debt_usd")


def vip_fico(c360: DataFrame) -> DataFrame:
    return c360.agg(
        F.count_if(F.col("customer_segment") == "PLATINUM_VIP").alias("vip_customers"),
        F.coalesce(F.avg("credit_score"), F.lit(0.0)).alias("avg_credit_score"),
    )


def credit_tier_count(c360: DataFrame) -> DataFrame:
    return c360.groupBy("credit_tier").agg(F.count("customer_id").alias("customers"))


def spend_debt_sample(c360: DataFrame, rows: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED) -> DataFrame:
    """A repeatable sample of an exact size: the rows with the smallest seeded id hash."""
    rank = F.md5(F.concat_ws(":", "customer_id", F.lit(str(seed))))
    return (
        c360.orderBy(rank, "customer_id")
        .limit(rows)
        .select(
            "customer_id",
            "full_name",
            "customer_segment",
            "total_spend_usd",
            "total_loan_debt_usd",
            "total_balance_usd",
        )
    )


def customer_search(c360: DataFrame, keyword: str = "", rows: int = SEARCH_ROWS) -> DataFrame:
    """Customers whose name or id contains the (regular expression) keyword, any case."""
    if keyword:
        pattern = "(?i)" + keyword
        hit = F.coalesce(F.col("full_name").rlike(pattern), F.lit(False)) | F.coalesce(
            F.col("customer_id").rlike(pattern), F.lit(False)
        )
        c360 = c360.filter(hit)
    return c360.select(*SEARCH_COLUMNS).orderBy("customer_id").limit(rows)


def _mean(column: str, alias: str) -> Column:
    """Mean of a money column as a double, from the exact sum."""
    return F.coalesce(F.sum(column).cast("double") / F.count(column), F.lit(0.0)).alias(alias)


def branch_kpis(branch_days: DataFrame) -> DataFrame:
    """Branches, and the unweighted mean of the daily tickets, empty days included."""
    return branch_days.agg(
        F.count_distinct("branch_id").alias("total_branches"),
        _mean("avg_ticket_size_usd", "avg_ticket_usd"),
    )


def top_branches(branch_days: DataFrame, k: int = TOP_BRANCHES) -> DataFrame:
    by_name = branch_days.groupBy("branch_name").agg(_total("daily_transaction_volume_usd"))
    return by_name.orderBy(F.desc("daily_transaction_volume_usd"), "branch_name").limit(k)


def weekend_by_month(branch_days: DataFrame) -> DataFrame:
    weekend, weekday = WEEKEND_LABELS
    return (
        branch_days.groupBy("month_name", "is_weekend")
        .agg(F.sum("daily_transactions_count").alias("daily_transactions_count"))
        .withColumn("day_kind", F.when(F.col("is_weekend"), weekend).otherwise(weekday))
    )


def branch_ranking(branch_days: DataFrame) -> DataFrame:
    return (
        branch_days.groupBy("branch_id", "branch_name", "manager_name")
        .agg(
            F.sum("daily_transactions_count").alias("daily_transactions_count"),
            _total("daily_transaction_volume_usd"),
            _mean("avg_ticket_size_usd", "avg_ticket_size_usd"),
        )
        .orderBy(F.desc("daily_transaction_volume_usd"), "branch_id")
    )


def merchant_kpis(merchants: DataFrame) -> DataFrame:
    return merchants.agg(
        F.count_distinct("merchant_id").alias("total_merchants"), _total("estimated_interchange_fee_usd")
    )


def without_external(merchants: DataFrame, by_id: bool = False) -> DataFrame:
    """Leave out the external merchant: by its display name, or by the UNKNOWN id."""
    if by_id:
        return merchants.filter(F.col("merchant_id") != UNKNOWN_ID)
    return merchants.filter(F.col("merchant_name") != EXCLUDED_MERCHANT)


def top_merchants(merchants: DataFrame, k: int = TOP_MERCHANTS, by_id: bool = False) -> DataFrame:
    return (
        without_external(merchants, by_id)
        .select("merchant_id", "merchant_name", "total_sales_volume_usd", "estimated_interchange_fee_usd")
        .orderBy(F.desc("total_sales_volume_usd"), "merchant_id")
        .limit(k)
    )


def top_cities(merchants: DataFrame, k: int = TOP_CITIES, by_id: bool = False) -> DataFrame:
    by_city = without_external(merchants, by_id).groupBy("city").agg(_total("total_sales_volume_usd"))
    return by_city.orderBy(F.desc("total_sales_volume_usd"), "city").limit(k)


def merchant_detail(merchants: DataFrame, rows: int = DETAIL_ROWS) -> DataFrame:
    return merchants.select(*MERCHANT_COLUMNS).orderBy("merchant_id").limit(rows)


def risk_kpis(risk: DataFrame) -> DataFrame:
    """Totals, and the plain mean of the tiers' rates."""
    return risk.agg(
        F.coalesce(F.sum("total_loans_originated"), F.lit(0)).alias("total_loans"),
        _total("total_loan_debt_usd"),
        _mean("avg_interest_rate_pct", "avg_interest_rate_pct"),
    )


def interest_by_tier(risk: DataFrame) -> DataFrame:
    return risk.drop("mart_updated_at").orderBy("credit_risk_tier")
