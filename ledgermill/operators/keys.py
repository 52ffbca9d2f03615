"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_ROWS = 50_000


def dense_keys(
    members: DataFrame,
    id_col: str,
    key_col: str,
    after: Column | int = 0,
    bucket_rows: int = BUCKET_ROWS,
    at_most: int | None = None,
) -> DataFrame:
    """Number unique members ``after + 1, after + 2, ...`` without gaps.

    Members are spread over hash buckets of their id; a bucket's numbers start
    where the buckets before it end. There are as many as keep a bucket near
    ``bucket_rows`` members; ids are unique, so buckets are even, each is sorted
    on its own, and only one row per bucket meets in one task. ``at_most`` is a
    bound of the members that is cheaper to know than their number. The result
    depends on the ids and that bound alone, so a task that is run again after
    a lost executor gives the same keys.
    """
    buckets = max(1, -(-(members.count() if at_most is None else at_most) // bucket_rows))
    bucket = F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int")
    placed = members.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        members.select(bucket.alias("_bucket"))
        .groupBy("_bucket")
        .count()
        .select("_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    within = F.row_number().over(Window.partitionBy("_bucket").orderBy(id_col))
    first = F.lit(after) if isinstance(after, int) else F.coalesce(after, F.lit(0))
    return (
        placed.withColumn("_rank", within)
        .join(F.broadcast(starts), "_bucket")
        .select((first + F.col("_start") + F.col("_rank")).cast("bigint").alias(key_col), *members.columns)
    )


def load_keys(rows: DataFrame, key_col: str, after: Column | int = 0) -> DataFrame:
    """Unique, increasing but gappy keys for fact rows, with no shuffle.

    Nothing refers to a fact's own key, so it only has to be unique. Use this
    right before the rows are written: the stored key is the key.
    """
    first = F.lit(after) if isinstance(after, int) else F.coalesce(after, F.lit(0))
    key = (first + F.monotonically_increasing_id() + 1).cast("bigint")
    return rows.select(key.alias(key_col), *rows.columns)


def max_key(table: DataFrame, key_col: str) -> Column:
    return table.agg(F.max(key_col)).scalar()
