"""Helpers the operators of this package share."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A word is a run of characters other than ASCII space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only in local mode, where the session names none (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get("spark.master", "").startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        named = tempfile.mkdtemp(prefix="ledgermill-llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def written(df: DataFrame) -> DataFrame:
    """Write the rows as a Parquet table in the shared folder and read them back.

    This cuts the lineage: a lost executor costs a re-read of its files and no
    recomputation of what led to them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def learns(doc_id: Column) -> Column:
    """Rows whose labels may be learnt from: crc32 of the id's text modulo 3 is not 1."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 != 1, F.lit(False))


def carried(docs: DataFrame) -> DataFrame:
    """``doc, doc_id, row, text_hash``: all columns of a row as one, so none can clash, beside what tells rows apart."""
    return docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("doc"),
        "doc_id",
        F.xxhash64("doc_id", "text").alias("row"),
        F.xxhash64("text").alias("text_hash"),
    )


def sampled(rows: DataFrame, by: str, limit: int, seed: int = 42) -> DataFrame:
    """At most ``limit`` rows, those with the smallest hashes of ``by``: the same ones in every run.

    With many more rows, those whose hash is surely too large are left out
    before any are ranked, so about twice the limit is all that meets in a task.
    """
    share = 2 * limit / max(1, rows.count())
    place = F.xxhash64(by, F.lit(seed))
    some = rows if share >= 1 else rows.where(place < F.lit(int((share - 0.5) * 2**64)))
    return some.orderBy(place, by).limit(limit)


def numbered(rows: DataFrame, group: str, by: str | list[str], out: str, per_task: int = 50_000) -> DataFrame:
    """Number the rows of each (non-null) group 0, 1, 2, ... without gaps and without a task per group.

    Rows fall into hash buckets of ``by``, as many as keep a bucket near
    ``per_task`` rows; each bucket is sorted on its own and starts where the
    buckets before it in its group end. Rows that agree in ``by`` share a
    bucket, so ``by`` should be nearly unique; equal rows get different numbers.
    """
    by = [by] if isinstance(by, str) else by
    total = rows.count()
    buckets = max(1, math.ceil(total / per_task))
    placed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(group, "_bucket").count().select(
        group, "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")
    )
    within = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*by))
    return (
        placed.withColumn("_rank", within)
        .join(starts, [group, "_bucket"])
        .withColumn(out, (F.col("_start") + F.col("_rank") - 1).cast("bigint"))
        .select(*rows.columns, out)
    )


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """Connected components of ``edges(a, b)``: ``(node, component)``, the component being its smallest node.

    Large stars and small stars in turn: every node hands its larger, then its
    smaller, neighbours to the smallest it knows, until each component is one
    star. Minima are aggregated before the shuffle; a hub is a join key whose
    rows the engine may split, as its other side is one row. Each round is a
    written table, so nothing is recomputed and nothing reaches the driver but
    two numbers that tell whether the round changed anything. Nodes without an
    edge are not returned. Raises if ``rounds`` do not suffice.
    """
    pairs = written(
        edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct()
    )
    seen = None
    for _ in range(rounds):
        both = pairs.select("v", "u").unionByName(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("c"), F.least("m", "v").alias("m"))
        large = (
            both.where("u > v").join(least, F.col("v") == F.col("c")).select(F.col("u").alias("v"), F.col("m").alias("u"))
            .distinct()
        )
        down = large.groupBy("v").agg(F.min("u").alias("m")).select(F.col("v").alias("c"), "m")
        small = (
            large.join(down, F.col("v") == F.col("c"))
            .select(F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")), F.struct("v", F.col("m").alias("u")))).alias("e"))
            .select("e.v", "e.u").where("v <> u").distinct()
        )
        pairs = written(small)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return pairs.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(
        pairs.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    )
