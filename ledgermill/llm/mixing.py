"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import WORD, carried, table, written

GROUP_ROWS = 2_000
"""Rows that one task pairs at a time; a source of any size is split into such groups."""
FAN_IN = 64
"""Groups whose residuals meet in one group of the next level of the reduction tree."""
RUNG = 2
SPARES = 4_096
"""Of the rows it takes, and of those it leaves, a group hands up at most ``RUNG`` for each power of two of size; all that meet hand up at most ``SPARES`` more."""
BROADCAST_SOURCES = 50_000
"""Up to so many sources (about 100 bytes each) are sent to all tasks; beyond, they are joined by a shuffle."""

# Fixed values of the mixture the query asks for.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``sources(source, source_size)`` with the words each should give: ``target``.

    Weights repeat over the sources by code point, null last. Together they
    give ``share`` times all words; none gives over ``most`` times its own, and
    what a source can't give is shared by weight among the others until none is
    above. Each round is one aggregate over a row per source; every round caps
    a source or is the last.
    """
    # one row per source meets here, never one per document
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    ranked = written(sources.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(most)).alias("most")))
    wanted = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        over = F.col("weight") * level > F.col("most")
        row = ranked.agg(
            F.count(F.when(over, 1)).alias("full"),
            F.sum(F.when(over, F.col("most")).otherwise(0.0)).alias("given"),
            F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (wanted - row["given"]) / row["weight"]
    return ranked.select("source", "source_size", F.least("most", F.col("weight") * level).alias("target"))


def draws(ids: np.ndarray, seed: int, level: int) -> np.ndarray:
    """A number in [0, 1) for each id, the same in every run (the splitmix64 finisher)."""
    with np.errstate(over="ignore"):
        x = ids.astype(np.uint64) + np.uint64((seed * 1_000_003 + level * 7_919) % (1 << 64)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(np.float64) / (1 << 53)


def pivot(size: np.ndarray, part: np.ndarray, draw: np.ndarray) -> int:
    """Round the fractions ``part`` in place but for one; returns its place, or -1 if none is left.

    A pair shares its words, ``size * part`` together: either the first takes
    all it can hold or the second does, with the odds that keep each one's
    expectation. One of the two becomes 0 or 1; the other goes on to the next
    pair, so the sum of words never changes.
    """
    open_at = -1
    for k in range(len(size)):
        if not 0.0 < part[k] < 1.0:
            continue
        if open_at < 0:
            open_at = k
            continue
        i, a, b = open_at, size[open_at] * part[open_at], size[k] * part[k]
        together = a + b
        high, low = min(size[i], together), together - min(size[k], together)
        first = high if draw[k] * (high - low) < a - low else low
        second = together - first
        part[i] = _whole(first / size[i])
        part[k] = _whole(second / size[k])
        open_at = i if 0.0 < part[i] < 1.0 else k if 0.0 < part[k] < 1.0 else -1
    return open_at


def settle(size: np.ndarray, part: np.ndarray, left: int) -> None:
    """Round a source's last fraction to the nearer side and let the other rows at hand make up for the miss.

    Rows come largest first. A row changes sides only where that brings the
    source's words nearer to its target.
    """
    miss = size[left] * (round(part[left]) - part[left])
    part[left] = round(part[left])
    for k in range(len(size)):
        change = size[k] * (1 - 2 * part[k])
        if k != left and abs(miss + change) < abs(miss):
            part[k], miss = 1 - part[k], miss + change


def _whole(x: float) -> float:
    return 0.0 if x < 1e-12 else 1.0 if x > 1 - 1e-12 else x


def spare(size: np.ndarray, part: np.ndarray, need: float, most: int) -> np.ndarray:
    """Decided rows that go up the tree, of those taken and of those not: a few of each power of two of size, and the smallest that hold ``need`` words.

    Of either side at most ``RUNG`` rows go for each power of two and ``most``
    besides, so what a group hands up is bounded whatever its rows are.
    """
    out = np.zeros(len(size), bool)
    for side in (0.0, 1.0):
        rows = np.flatnonzero((part == side) & (size > 0))[::-1]  # rows come largest first
        power = np.frexp(size[rows])[1]
        nth = np.arange(len(rows)) - np.searchsorted(power, power)
        before = np.cumsum(size[rows]) - size[rows]
        smallest = (before < need) & (np.arange(len(rows)) < most)
        out[rows[smallest | (nth < RUNG)]] = True
    return out


def rounder(seed: int, level: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def rounded(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "id_hash"], ascending=[False, True], kind="stable")
        ids, part = group["id_hash"].to_numpy(), group["part"].to_numpy(float).copy()
        size = group["size"].to_numpy(float)
        left = pivot(size, part, draws(ids, seed, level))
        if last and left >= 0:
            settle(size, part, left)
        up = (part > 0) & (part < 1)
        if not last and len(group):
            # the groups that meet above hold what makes up for half the longest row together
            meet = min(FAN_IN, int(group["meeting"].iloc[0]))
            up |= spare(size, part, float(group["largest"].iloc[0]) / 2 / meet, SPARES // meet)
        meeting = -(-group["meeting"] // FAN_IN)
        return group.assign(part=part, up=up, bucket=group["bucket"] // FAN_IN, meeting=meeting)

    return rounded


def copies(docs: DataFrame, seed: int = 1, **mixture) -> DataFrame:
    """How often each of ``docs(doc_id, text, source)`` is taken.

    Returns ``doc_id, text_hash, size, source, source_size, target, copies``:
    one row per input row. ``size`` counts the text's words; a document's
    expected copies are its source's target over its source's size, the same
    for all of a source. Whole copies are given, fractions are rounded by
    pairs: inside groups of at most about ``GROUP_ROWS`` rows first, then each group's one
    residual meets those of ``FAN_IN`` groups, up the tree, until a source has
    one left, which ``settle`` rounds. With it go a bounded number of each
    group's decided rows, ``spare`` tells which, and make up for the miss: a
    source's words miss its target by half a short document where those rows
    hold half its longest one, and by half a document at most. Draws depend on
    ids alone; reruns agree.

    A null text or one without words has size 0 and is taken by whole copies
    only; a null source is a source, the last one; null ids and repeated rows
    are rounded like any other; an empty table gives no rows.
    """
    measured = written(
        docs.select(
            "doc_id",
            F.xxhash64("text").alias("text_hash"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            F.col("source").cast("string").alias("source"),
        )
    )
    per_source = measured.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"), F.max("size").alias("largest"))
    counted = written(per_source)
    goal = targets(counted.select("source", "source_size"), **mixture)
    plan = written(
        goal.join(counted.select(F.col("source").alias("s"), "rows", "largest"), F.col("source").eqNullSafe(F.col("s"))).select(
            F.xxhash64(F.col("source").isNull(), "source").alias("source_key"),
            F.col("source").alias("s"),
            "source_size",
            "target",
            "largest",
            F.ceil(F.col("rows") / GROUP_ROWS).cast("bigint").alias("groups"),
        )
    )
    number, most = plan.agg(F.count("*"), F.max("groups")).first()
    side = F.broadcast(plan) if number <= BROADCAST_SOURCES else plan
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    id_hash = F.xxhash64("doc_id", "text_hash")
    rows = measured.join(side, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("doc_id").cast("string"), "text_hash", "size", "source", "source_key", "source_size", "target", id_hash.alias("id_hash"),
        F.floor(rate).cast("int").alias("whole"),
        F.when(F.col("size") > 0, rate - F.floor(rate)).otherwise(F.lit(0.0)).alias("part"),
        F.pmod(F.xxhash64(id_hash, F.lit(seed)), F.col("groups")).alias("bucket"),
        "largest",
        F.col("groups").alias("meeting"),
        F.lit(False).alias("up"),
    )
    schema = rows.schema
    decided, level, most = [], 0, most or 1
    while True:
        level += 1
        last = most == 1

        done = written(rows.groupBy("source_key", "bucket").applyInPandas(rounder(seed, level, last), schema))
        decided.append(done.where("NOT up"))
        if last:
            break
        rows, most = done.where("up"), math.ceil(most / FAN_IN)
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    return out.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text_hash", "size", "source", "source_size", "target", (F.col("whole") + F.col("part").cast("int")).alias("copies")
    )


def mixed(docs: DataFrame, seed: int = 1, **mixture) -> DataFrame:
    """``docs`` with each row as often as ``copies`` takes it; all columns stay.

    Rows equal in id and text are interchangeable: each gets one of the counts
    found for them.
    """
    taken = copies(docs, seed, **mixture).select(F.xxhash64("doc_id", "text_hash").alias("id_hash"), "text_hash", "copies")
    # as many as there are rows equal in id and text
    counts = taken.groupBy("id_hash", "text_hash").agg(F.array_sort(F.collect_list("copies")).alias("counts"))
    rows = carried(docs).withColumn("id_hash", F.xxhash64("doc_id", "text_hash"))
    same = Window.partitionBy("id_hash", "text_hash").orderBy(F.lit(0))
    numbered = rows.join(counts, ["id_hash", "text_hash"]).withColumn("nth", F.row_number().over(same))
    number = F.element_at("counts", F.col("nth"))
    kept = numbered.withColumn("number", number).where("number > 0")
    return kept.select("doc", F.explode(F.sequence(F.lit(1), F.col("number")))).select("doc.*")


def op2_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mixture takes."""
    found = copies(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("bigint").alias("taken"))
