"""Joins that hold up when one key carries a large share of the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 << 20
HELD_BYTES = 8 << 20
"""Of a table that is held for many joins, about what a partition holds."""
HOT_SHARE = 1 / 1024
COUNTED_SHARE = 0.05


def frequent_keys(rows: DataFrame, key: str, hot_share: float = HOT_SHARE, share: float = 1.0) -> list:
    """Non-null keys that hold at least ``hot_share`` of the rows, counted on a ``share`` of them.

    There can be no more than ``1 / hot_share`` such keys, which bounds the list.
    """
    counted = rows.select(key) if share >= 1 else rows.select(key).sample(share, seed=7)
    per_key = counted.groupBy(key).count()
    least = per_key.agg(F.sum("count") * F.lit(float(hot_share)))
    top = per_key.filter(F.col(key).isNotNull() & (F.col("count") > 1) & (F.col("count") >= least.scalar()))
    return [r[0] for r in top.orderBy(F.desc("count"), key).select(key).collect()]


def spread_lookup(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: str,
    seen: DataFrame | None = None,
    hot_share: float = HOT_SHARE,
    share: float = COUNTED_SHARE,
    cold: DataFrame | None = None,
) -> DataFrame:
    """Left join to a large table with unique keys, without piling hot keys on one task.

    Every key that holds a ``hot_share`` of the rows, whether ``table`` holds it or
    not, is resolved by a broadcast of as many rows. Their rows go through the
    shuffle join under their own hash as a salt that matches nothing, so they are
    spread over all tasks, however many there are; all others meet their match
    under salt 0. Null keys match nothing and are spread as well.

    ``seen`` may be a cheaper frame to count frequencies on, and ``share`` the part
    of it that is counted. Both only steer the spreading: every key is joined
    correctly whether or not it is found hot. The hot keys are fixed before the
    join is planned, so a task that is run again sees the same ones.

    ``cold`` may be the table's :func:`cold_rows` as they were dealt out before.
    """
    values = [c for c in table.columns if c != key]
    keys = frequent_keys(rows if seen is None else seen, key, hot_share, share)
    is_hot = F.col(key).isin(keys)
    # an odd hash is never 0
    salt = F.when(F.col(key).isNull() | is_hot, F.xxhash64(spread_by).bitwiseOR(F.lit(1))).otherwise(F.lit(0))
    hot = table.filter(is_hot).select(key, F.struct(*values).alias("_hot_values"))
    marked = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", salt)
    return marked.join(cold_rows(table, key) if cold is None else cold, [key, "_salt"], "left").select(
        *rows.columns,
        *[F.coalesce(F.col(f"_hot_values.{v}"), F.col(f"_cold_values.{v}")).alias(v) for v in values],
    )


def cold_rows(table: DataFrame, key: str) -> DataFrame:
    """What rows under salt 0 meet in :func:`spread_lookup`."""
    values = [c for c in table.columns if c != key]
    # a literal 0 would be folded into a plain condition and drop out of the shuffle key
    zero = F.pmod(F.xxhash64(key), F.lit(1))
    return table.select(key, zero.alias("_salt"), F.struct(*values).alias("_cold_values"))


def stored_bytes(table: DataFrame) -> int:
    """What the rows of a table take in memory, about: 16 bytes a row, 8 a column, and the length of texts."""
    texts = [f.name for f in table.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    fixed = F.lit(16 + 8 * len(table.columns))
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), fixed)
    return table.agg(F.sum(size)).first()[0] or 0


@dataclass(frozen=True)
class Held:
    """A stored table that batches of rows are joined to one after another (:func:`held`)."""

    table: DataFrame
    cold: DataFrame | None

    def release(self) -> None:
        if self.cold is not None:
            self.cold.unpersist()


def held(table: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES) -> Held:
    """Measure a table once for all joins to come and, if it's too large to broadcast, deal it out and sort it by key once.

    A join then moves and sorts the batch only; the table's partitions stay in
    files of the executors until :meth:`Held.release`, and one that is lost with
    its executor is made again from the stored table.
    """
    size = stored_bytes(table)
    if size <= broadcast_bytes:
        return Held(table, None)
    on = [key, "_salt"]
    parts = max(table.sparkSession.sparkContext.defaultParallelism, -(-size // HELD_BYTES))
    cold = cold_rows(table, key).repartition(parts, *on).sortWithinPartitions(*on).persist(StorageLevel.DISK_ONLY)
    cold.count()
    return Held(table, cold)


def lookup(
    rows: DataFrame,
    table: DataFrame | Held,
    key: str,
    spread_by: str,
    seen: DataFrame | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Left join to a stored table with unique keys; broadcast it only if it is measured small.

    One that is held was measured before.
    """
    if isinstance(table, Held):
        if table.cold is None:
            return rows.join(F.broadcast(table.table), key, "left")
        return spread_lookup(rows, table.table, key, spread_by, seen, cold=table.cold)
    if stored_bytes(table) <= broadcast_bytes:
        return rows.join(F.broadcast(table), key, "left")
    return spread_lookup(rows, table, key, spread_by, seen)


def absent_from(batch: DataFrame, existing: DataFrame, id_col: str) -> DataFrame:
    """Rows of a batch whose id is not in a much larger stored table.

    The ids both sides share are found first with the batch as the inner side,
    so a small batch is sent to the stored files instead of every stored id
    being shuffled; the anti join then meets at most one batch of ids.
    """
    present = existing.select(id_col).join(batch.select(id_col), id_col, "left_semi")
    return batch.join(present, id_col, "left_anti")


def bucket_of(id_col: str, buckets: int) -> Column:
    """The folder an id's copy is kept in."""
    return F.pmod(F.xxhash64(id_col), F.lit(buckets)).cast("int")


def in_buckets(rows: DataFrame, id_col: str, buckets: int) -> DataFrame:
    """``id_col`` and its ``id_bucket``, to be written by bucket."""
    return rows.select(id_col, bucket_of(id_col, buckets).alias("id_bucket"))


def absent_from_buckets(batch: DataFrame, ids: DataFrame, id_col: str, buckets: int) -> DataFrame:
    """Rows of a stored batch whose id is not among ids stored by :func:`in_buckets` with the same number of buckets.

    Only the folders of buckets the batch has an id in are read; their numbers,
    at most ``buckets``, are fixed before the scan is planned. Of what is read,
    the ids both sides share are found with the batch as the inner side, bucket
    and id being the key, so a small batch is sent to the stored files.

    ``ids`` of several loads should be one scan of their folders, as ``Layers``
    opens a table. Spark 4.1 takes a union of scans, joined here by shuffles,
    for one that keeps their partitions, and fails where it is read twice
    (``Can't zip RDDs with unequal numbers of partitions``).
    """
    placed = batch.withColumn("id_bucket", bucket_of(id_col, buckets))
    touched = sorted(r[0] for r in placed.select("id_bucket").distinct().collect())
    near = ids.where(F.col("id_bucket").isin(touched))
    on = ["id_bucket", id_col]
    present = near.select(*on).join(placed.select(*on), on, "left_semi")
    return placed.join(present, on, "left_anti").select(*batch.columns)
