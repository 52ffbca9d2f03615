"""Benchmark decontamination by spaced seeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import carried, table, written

# Words are lower-cased runs of characters other than ASCII signs, spaces and controls.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

WINDOW = 13
SUBSTITUTIONS = 2
MASKS = ((0, 1, 3, 5, 6, 7), (0, 1, 2, 5, 7, 8))
"""The positions each seed looks at. Wherever two words of thirteen differ, one of these fits beside them (see the tests)."""
BROADCAST_SEEDS = 200_000
"""Up to so many seeds of the tests (about 250 bytes each) are sent to all tasks; beyond, both sides are shuffled."""
CHUNK = 64
"""Places a row of seeds is made from; it holds the words around them besides."""
MANY = 1 << 30
"""More partitions than there are: coalescing to so many moves nothing."""


def token_hashes(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), BETWEEN), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def _seed(at: Column, number: int, mask: tuple[int, ...]) -> Column:
    """The seed's hash at a place of the chunk; null where it doesn't fit."""
    kept = F.xxhash64(F.lit(number), *(F.get(F.col("chunk"), at + o) for o in mask))
    return F.when(at + mask[-1] < F.size("chunk"), kept)


def _seeds(rows: DataFrame, masks: list[tuple[int, ...]], window: int) -> DataFrame:
    """All seeds of ``rows(tokens, ...)``: ``seed`` and its place ``at`` beside the row's other columns.

    Texts are cut into chunks of ``CHUNK`` places first, each with the
    ``window`` words before and behind, so the rows that follow are short
    however long a text is: ``chunk`` are its words, ``local`` the place in it.
    """
    size = F.size("tokens")
    base = lambda start: F.greatest(start - (window - 1), F.lit(0))
    cut = lambda start: F.struct(
        start.alias("start"), F.slice("tokens", base(start) + 1, start - base(start) + CHUNK + window).alias("chunk")
    )
    cuts = F.when(size > 0, F.transform(F.sequence(F.lit(0), size - 1, F.lit(CHUNK)), cut))
    kept = [c for c in rows.columns if c != "tokens"]
    # the outer form keeps the optimiser from working out the tokens once more to test for empty texts
    chunks = rows.select(*kept, F.explode_outer(cuts).alias("c")).where("c IS NOT NULL")
    # a step of its own: it hands on one chunk at a time, where a fused one would hold all seeds of a text
    chunks = chunks.coalesce(MANY).select(*kept, "c.start", "c.chunk").withColumn("base", base(F.col("start")))
    first = F.col("start") - F.col("base")
    places = F.sequence(first, F.least(first + CHUNK, F.size("chunk")) - 1)
    placed = chunks.select(*kept, "base", "chunk", F.explode(places).alias("local"))
    each = F.array(*(_seed(F.col("local"), k, m) for k, m in enumerate(masks)))
    found = placed.select("*", F.explode(each).alias("seed")).where(F.col("seed").isNotNull())
    return found.withColumn("at", F.col("base") + F.col("local"))


def _around(window: int) -> tuple[Column, Column]:
    """The words of a chunk around a place, and the place among them."""
    back = F.least(F.col("local"), F.lit(window - 1))
    return F.slice("chunk", F.col("local") - back + 1, back + window), back


def _verified(window: int, substitutions: int) -> tuple[Column, Column]:
    """Whether words match, and each window's matching words and whether they are enough.

    Only windows that hold the seed are looked at, so a hit costs the same
    however long the texts are.
    """
    size = F.least(F.lit(window), F.col("item_size"))
    need = F.when(F.col("item_size") >= window, F.lit(window - substitutions)).otherwise(F.col("item_size"))
    back = F.least("near_at", "item_near_at")
    ahead = F.least(F.size("near") - F.col("near_at"), F.size("item_near") - F.col("item_near_at"))
    cut = lambda c, at: F.slice(c, F.col(at) - back + 1, back + ahead)
    same = F.zip_with(cut("near", "near_at"), cut("item_near", "item_near_at"), lambda a, b: (a == b).cast("int"))
    sums = F.transform(
        F.sequence(F.lit(0), back + ahead - size), lambda s: F.aggregate(F.slice("_same", s + 1, size), F.lit(0), lambda x, y: x + y)
    )
    found = F.when(back + ahead >= size, sums)
    return same, F.transform(found, lambda n: F.struct((n >= need).alias("good"), n.alias("matched")))


def contamination(
    docs: DataFrame, tests: DataFrame, window: int = WINDOW, substitutions: int = SUBSTITUTIONS, masks=MASKS
) -> DataFrame:
    """``row, text_hash, doc_id, item_id, matched, first_word``: each document that holds a passage of a test item.

    A passage is ``window`` consecutive words of the item of which at most
    ``substitutions`` differ in the document, word for word in place; an item
    of fewer words must stand whole and unchanged. ``matched`` is the most
    words a passage has in common, ``first_word`` where the first one starts in
    the document. ``row`` and ``text_hash`` tell rows of ``docs`` apart.

    Spaced seeds of both sides are joined on equality, and the words around
    each hit are compared. The masks given by default lose no passage of 13
    words with two substitutions. Equal items are searched once. Case and
    punctuation don't count. Nulls and empty texts hold nothing, nor do empty
    tables; null ids are carried along; repeated rows are found as one row of
    the result. Other columns are ignored.
    """
    items = written(
        tests.select("item_id", token_hashes("text").alias("item_tokens")).where(F.size("item_tokens") > 0)
    )
    once = items.groupBy("item_tokens").agg(F.min("item_id").alias("item")).select("item", "item_tokens")
    span = max(m[-1] for m in masks) + 1
    short = [r[0] for r in once.where(F.size("item_tokens") < span).select(F.size("item_tokens")).distinct().collect()]
    every = [*masks, *(tuple(range(n)) for n in sorted(short))]
    near, near_at = _around(window)
    sized = once.select("item", F.size("item_tokens").alias("item_size"), F.col("item_tokens").alias("tokens"))
    wanted = written(
        _seeds(sized, every, window).select(
            "seed", "item", "item_size", near.alias("item_near"), near_at.alias("item_near_at")
        )
    )
    few = wanted.count() <= BROADCAST_SEEDS
    rows = docs.select(
        F.xxhash64("doc_id", "text").alias("row"), F.xxhash64("text").alias("text_hash"), "doc_id", token_hashes("text").alias("tokens")
    )
    met = _seeds(rows, every, window).join(F.broadcast(wanted) if few else wanted, "seed")
    hits = met.withColumns({"near": near, "near_at": near_at})
    same, windows = _verified(window, substitutions)
    start = F.col("at") - F.least("near_at", "item_near_at")
    judged = hits.withColumn("_same", same).withColumn("_windows", windows)
    good = judged.where(F.exists("_windows", lambda w: w["good"])).select(
        "row", "text_hash", "doc_id", "item",
        F.array_max("_windows.matched").alias("matched"),
        (start + F.array_position("_windows.good", True) - 1).cast("bigint").alias("first_word"),
    )
    pairs = good.groupBy("row", "text_hash", "doc_id", "item").agg(
        F.max("matched").cast("bigint").alias("matched"), F.min("first_word").alias("first_word")
    )
    same_items = items.join(once.withColumnRenamed("item_tokens", "_t"), F.col("item_tokens") == F.col("_t")).select("item", "item_id")
    return pairs.join(same_items, "item").select("row", "text_hash", "doc_id", "item_id", "matched", "first_word")


def decontaminated(docs: DataFrame, tests: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that hold a passage of a test item; all columns stay."""
    found = contamination(docs, tests, **options)
    gone = found.select("row", "text_hash").distinct()
    return carried(docs).join(gone, ["row", "text_hash"], "left_anti").select("doc.*")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold passages of ``benchmark``: a row per document and item."""
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max("matched").alias("matched"), F.min("first_word").alias("first_word"))


OP5_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(text), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dg AS (SELECT doc_id, p, w[p:p + 3] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS p FROM d)),
bg AS (SELECT item_id, p, w[p:p + 3] AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 2)) AS p FROM b WHERE len(w) >= 13)),
diagonal AS (SELECT DISTINCT doc_id, item_id, dg.p - bg.p AS shift FROM dg JOIN bg USING (g)),
win AS (
  SELECT doc_id, item_id, q + shift AS p, list_sum([(x[1] = x[2])::INT FOR x IN list_zip(d.w[q + shift:q + shift + 12], b.w[q:q + 12])]) AS n
  FROM (SELECT *, unnest(range(1, len(b.w) - 11)) AS q FROM diagonal JOIN b USING (item_id)) AS b JOIN d USING (doc_id)
  WHERE q + shift >= 1 AND q + shift + 12 <= len(d.w)
)
SELECT doc_id, item_id, max(n)::BIGINT AS matched, min(p) - 1 AS first_word FROM win WHERE n >= 11 GROUP BY doc_id, item_id
"""
