"""Line dedup by overlapping three-line windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import table

LINES = 3


def _windows(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` with every ``width`` consecutive lines: their start ``at`` and 128 bits of hash, ``h`` and ``g``.

    Lines are hashed once, windows from the lines' hashes; each step is a
    column of its own, so that none is worked out again for every window.
    """
    line = lambda x: F.struct(F.xxhash64(x).alias("h"), F.xxhash64(F.lit(width), x).alias("g"))
    hashed = rows.withColumn("_lines", F.split("text", "\n")).withColumn("_hashes", F.transform("_lines", line))
    hashes = F.col("_hashes")
    taken = lambda at, f: F.xxhash64(*(F.get(hashes, at + k)[f] for k in range(width)))
    starts = F.sequence(F.lit(0), F.size(hashes) - width)
    windows = F.when(F.size(hashes) >= width, F.transform(starts, lambda at: F.struct(taken(at, "h").alias("h"), taken(at, "g").alias("g"))))
    # the outer form keeps the optimiser from hashing once more to test for short texts
    each = hashed.select(*rows.columns, F.posexplode_outer(windows).alias("at", "w"))
    return each.where("w IS NOT NULL").select(*(c for c in rows.columns if c != "text"), "at", "w.h", "w.g")


def without_repeated_lines(docs: DataFrame, width: int = LINES) -> DataFrame:
    """``doc_id, n_lines, n_removed, kept`` for each row of ``docs(doc_id, text)``.

    Every ``width`` consecutive lines are a window. Of windows with the same
    lines, anywhere, the first stays (by id, then text, then position); the
    lines the later ones cover go, overlaps merged. ``kept`` joins the other
    lines by line breaks. Windows are judged on the input.

    First places come from an aggregate that combines before the shuffle, so a
    window in a third of all documents costs a row per task there; windows seen
    once are dropped before places meet them.

    Lines end at LF and are compared unchanged. A null text has no lines (kept
    is null), an empty one has one empty line; shorter texts have no window and
    stay. Null ids come last; rows equal in id and text are one document and
    share their fate; an empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("row"), F.xxhash64("text").alias("text_hash")
    )
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "row", "at").alias("place")
    windows = _windows(rows, width).select("h", "g", place)
    first = windows.groupBy("h", "g").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    repeated = first.where("first <> last").select("h", "g", "first")
    later = windows.join(repeated, ["h", "g"]).where(F.col("place") > F.col("first"))
    gone = later.groupBy("place.row", "place.text_hash").agg(F.collect_set("place.at").alias("starts"))
    joined = rows.join(gone, ["row", "text_hash"], "left").withColumn("lines", F.split("text", "\n"))
    covered = F.flatten(F.transform("starts", lambda at: F.sequence(at, at + width - 1)))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    stay = F.when(F.col("starts").isNull(), places).otherwise(F.array_except(places, covered))
    return joined.withColumn("stay", stay).select(
        "doc_id",
        F.coalesce(F.when(F.col("text").isNotNull(), F.size("lines")), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size("lines") - F.size("stay")), F.lit(0)).cast("bigint").alias("n_removed"),
        F.when(F.col("starts").isNull(), F.col("text"))
        .otherwise(F.array_join(F.transform("stay", lambda at: F.get(F.col("lines"), at)), "\n"))
        .alias("kept"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines of each document repeat earlier ones, and the digest of what stays."""
    found = without_repeated_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


OP8_SQL = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
win AS (
  SELECT doc_id, p, list_slice(l, p, p + 2) AS lines FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS p FROM l)
),
ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY lines ORDER BY doc_id, p) AS nth FROM win),
cover AS (SELECT DISTINCT doc_id, unnest(range(p, p + 3)) AS q FROM ranked WHERE nth > 1),
every AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS q FROM l),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY q) AS text, count(*) AS n FROM every ANTI JOIN cover USING (doc_id, q) GROUP BY doc_id
)
SELECT doc_id, len(l) AS n_lines, len(l) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM l LEFT JOIN kept USING (doc_id)
"""
