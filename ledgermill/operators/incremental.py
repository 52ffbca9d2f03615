"""The demonstration batch: generate, append, measure, reset."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.functions import date_key
from ledgermill.operators.facts import TRANSACTION_COLUMNS
from ledgermill.schemas import DIMENSIONS, MONEY, UNKNOWN_ID

# Id prefix, day, amounts and sample sizes of the demonstration batch.
DEMO_PREFIX = "TXN_DEMO_"
DEMO_LIKE = "TXN_DEMO_%"
DEMO_START = datetime(2026, 10, 12, 10, 30)
DEMO_ROWS = 5000
AMOUNT_BASE, AMOUNT_STEP, AMOUNT_SPAN = "500", "14.5", "74500"
# dimension -> (members sampled, positions cycled through)
SAMPLES = {
    "dim_customer": (2000, 1990),
    "dim_account": (2000, 1990),
    "dim_card": (1000, 990),
    "dim_merchant": (500, 490),
    "dim_branch": (100, 95),
}


def demo_dates(spark: SparkSession, start: datetime = DEMO_START) -> DataFrame:
    return spark.range(1).select(F.lit(start.date()).alias("full_date"))


def positions(dim: DataFrame, natural_key: str, surrogate_key: str, members: int) -> DataFrame:
    """The first ``members`` real members by id with positions 0, 1, ... (at most that many rows)."""
    first = (
        dim.filter(F.col(natural_key) != UNKNOWN_ID)
        .select(natural_key, surrogate_key)
        .orderBy(natural_key)
        .limit(members)
    )
    place = F.row_number().over(Window.orderBy(natural_key)) - 1
    return first.select(place.alias("_at"), surrogate_key)


def _amount(i: Column) -> Column:
    step = F.lit(AMOUNT_STEP).cast("decimal(4,1)")
    return F.round(
        F.lit(AMOUNT_BASE).cast("int") + (i.cast("decimal(12,0)") * step) % F.lit(AMOUNT_SPAN).cast("int"), 2
    ).cast(MONEY)


def generate_batch(
    spark: SparkSession,
    dims: dict[str, DataFrame],
    rows: int = DEMO_ROWS,
    start: datetime = DEMO_START,
) -> DataFrame:
    """Synthetic transactions that cycle through known members by position.

    A position beyond the members there are leaves the key null.
    """
    i = F.col("_i")
    batch = spark.range(1, rows + 1).withColumnRenamed("id", "_i")
    for name, (members, cycle) in SAMPLES.items():
        spec = DIMENSIONS[name]
        numbered = positions(dims[name], spec.natural_key, spec.surrogate_key, members)
        batch = batch.withColumn("_at", i % cycle).join(F.broadcast(numbered), "_at", "left").drop("_at")
    moment = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    # at least six digits; lpad would cut longer numbers
    number = F.when(i < 1_000_000, F.lpad(i.cast("string"), 6, "0")).otherwise(i.cast("string"))
    return batch.select(
        F.concat(F.lit(DEMO_PREFIX), number).alias("transaction_id"),
        "customer_key",
        "account_key",
        "card_key",
        "merchant_key",
        "branch_key",
        date_key(F.lit(start.date())).alias("date_key"),
        _amount(i).alias("amount_usd"),
        (moment + F.make_dt_interval(secs=i)).cast("timestamp_ntz").alias("transaction_date"),
    ).select(*TRANSACTION_COLUMNS)


def metrics(fact_transactions: DataFrame, c360: DataFrame, branch_days: DataFrame) -> DataFrame:
    """Snapshot (metric, value): transactions, volume, demo transactions, mart rows."""
    facts = fact_transactions.agg(
        F.count("*").cast("decimal(38,2)").alias("total_txns"),
        F.coalesce(F.sum("amount_usd"), F.lit(0)).cast("decimal(38,2)").alias("total_volume"),
        F.count_if(F.col("transaction_id").like(DEMO_LIKE)).cast("decimal(38,2)").alias("demo_txns"),
    )
    one_row = facts.withColumn(
        "customer_360_rows", c360.agg(F.count("*").cast("decimal(38,2)")).scalar()
    ).withColumn("branch_rows", branch_days.agg(F.count("*").cast("decimal(38,2)")).scalar())
    names = ["total_txns", "total_volume", "demo_txns", "customer_360_rows", "branch_rows"]
    return one_row.unpivot([], names, "metric", "value")


def compare(before: DataFrame, after: DataFrame) -> DataFrame:
    b = before.select("metric", F.col("value").alias("before"))
    a = after.select("metric", F.col("value").alias("after"))
    return b.join(a, "metric", "full_outer").withColumn("delta", F.col("after") - F.col("before"))


def without_demo(fact_transactions: DataFrame) -> DataFrame:
    """The fact without demonstration rows (``_`` in the pattern matches any character)."""
    return fact_transactions.filter(~F.col("transaction_id").like(DEMO_LIKE))
