"""Landed transaction files as a stream into the transaction fact."""

from __future__ import annotations

from collections.abc import Callable
from math import isqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgermill import schemas
from ledgermill.operators import facts
from ledgermill.operators.staging import clean_staging
from ledgermill.sources import raw

BATCH_BROADCAST_BYTES = 4 << 20
"""Larger tables are joined to a micro-batch by a shuffle: each one sends what it broadcasts through the driver anew, and there are more with more files."""


def transaction_stream(spark: SparkSession, base: str, max_files: int = 1000, multiline: bool = False) -> DataFrame:
    """New files under ``<base>/transactions`` as typed staging rows, read as strictly as in a batch."""
    schema = schemas.raw_schema("transactions").add("ingest_date", T.DateType())
    rows = (
        spark.readStream.schema(schema)
        .options(**raw.csv_options(multiline))
        .option("maxFilesPerTrigger", max_files)
        .csv(f"{base}/transactions")
    )
    typed = clean_staging(rows, "transactions")
    # filters go no further down than this, or every text they look at would be cleaned and parsed twice
    return typed.select(F.inline(F.array(F.struct(*typed.columns))))


STATE_STORE = {
    "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # a micro-batch saves its own ids; merged files of ids, which hold old ones too, are saved beside the work now and then
    "rocksdb.changelogCheckpointing.enabled": True,
    # ids that aren't in files yet stay in memory from batch to batch: not 64 MB a partition, as there is no bound for all
    "rocksdb.writeBufferSizeMB": 32,
    # else each new id is looked up once more, only to count the ids
    "rocksdb.trackTotalNumberOfRows": False,
}
STATE_TASKS = 4
"""Partitions of the state for each core at most: every one saves files with every micro-batch, however few ids it gets."""


def state_partitions(shuffle_partitions: int, cores: int) -> int:
    """The largest prime within both bounds.

    Files that were dealt out by a hash of the id have a share of the hashes
    each; only a number without common factors deals those out evenly.
    """
    most = min(shuffle_partitions, STATE_TASKS * cores)
    return next((n for n in range(most, 1, -1) if all(n % k for k in range(2, isqrt(n) + 1))), 1)


def first_of_each(stream: DataFrame, delay: str | None = None) -> DataFrame:
    """Valid rows whose transaction id has not come before, by ids in the keyed state of the stream.

    The state holds ids only, hash-partitioned as the shuffle is, and is saved
    with every micro-batch: nothing loaded before is read again. An invalid
    row doesn't take an id. Of rows of one id that first come together, one
    stays.

    All ids are kept, unless copies are known to come within a ``delay`` of the
    first ("30 days", by ``transaction_date``): then older ids are forgotten,
    and rows that come later than that are let through.
    """
    valid = facts.valid_transactions(stream)
    if delay is None:
        return valid.dropDuplicates(["transaction_id"])
    seen = F.col("transaction_date").cast("timestamp")
    marked = valid.withColumn("_seen", seen).withWatermark("_seen", delay)
    return marked.dropDuplicatesWithinWatermark(["transaction_id"]).drop("_seen")


def load_available(
    stream: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    delay: str | None = None,
) -> StreamingQuery:
    """Run the fact build on everything that has arrived, then stop.

    Rows of ids that came in earlier batches are left out by the stream's
    state (:func:`first_of_each`), which makes the load insert-if-absent. Each
    micro-batch is written under its own number; one that is run again after a
    failure starts from the state before it and replaces its first try. The
    state is kept in RocksDB files under the checkpoint, so it may exceed
    memory; its partitions are fixed by the first start (:func:`state_partitions`).

    The rows a micro-batch lets through are written down under the checkpoint,
    in place of those of the one before, and ``build`` gets them as stored: a
    streamed batch would read its files, and search and save its state, anew
    for each job the build runs on it.
    """
    spark, fresh = stream.sparkSession, f"{checkpoint}/fresh"

    def load(batch: DataFrame, batch_id: int) -> None:
        # most values are ids, which dictionaries make no smaller
        batch.write.mode("overwrite").option("parquet.enable.dictionary", False).parquet(fresh)
        rows = spark.read.schema(batch.schema).parquet(fresh)
        build(rows).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    for name, value in STATE_STORE.items():
        spark.conf.set(f"spark.sql.streaming.stateStore.{name}", value)
    # a stream copies the settings when it starts
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set(
        "spark.sql.shuffle.partitions", state_partitions(int(partitions), spark.sparkContext.defaultParallelism)
    )
    try:
        return (
            first_of_each(stream, delay)
            .writeStream.foreachBatch(load)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
