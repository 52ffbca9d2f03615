"""Filter interaction audit: what each filter removes in every order, duplicates found by radix tries over range-partitioned texts."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import UPPER, table, written

# The filters' letters, in the order of their mask bits.
FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
MASKS = 1 << len(FILTERS)

PREFIXES = tuple(4**k for k in range(2, 16))
"""Lengths in bytes a text's prefix may take; a text as long or shorter is its own prefix."""
PART_BYTES = 64 << 20
"""Bytes of texts a range holds at most, while ``MOST_PARTS`` suffice; a prefix that holds more than a range is lengthened."""
MOST_PARTS = 1 << 16
"""Ranges at most; beyond, ranges grow, and a task empties its trie between their prefixes."""
HEAVY = 1 << 18
"""Heavy prefixes of a length at most: beyond, a prefix may hold as much as gives no more of them."""
TRIE_BYTES, TRIE_ROWS = 32 << 20, 200_000
"""Texts and rows a task's trie takes before it is emptied into the output."""
BATCH_BYTES, BATCH_ROWS = 16 << 20, 10_000


class Trie:
    """A compressed radix trie: whole texts as paths, at each terminal the smallest id and the rows that came."""

    __slots__ = ("children", "end")

    def __init__(self) -> None:
        self.children: dict[int, tuple[bytes, Trie]] = {}
        self.end: list | None = None

    def insert(self, text: bytes, place: tuple, row) -> bool:
        """Add a row of a text; ``place`` orders ids. Tells whether the text is new."""
        node, at = self, 0
        while at < len(text):
            edge = node.children.get(text[at])
            if edge is None:
                leaf = Trie()
                node.children[text[at]] = (text[at:], leaf)
                node, at = leaf, len(text)
                break
            label, child = edge
            same = len(label) if text.startswith(label, at) else _common(label, text, at)
            if same < len(label):
                middle = Trie()
                middle.children[label[same]] = (label[same:], child)
                node.children[text[at]] = (label[:same], middle)
                child = middle
            node, at = child, at + same
        if node.end is None:
            node.end = [place, [(place, row)]]
            return True
        node.end[0] = min(node.end[0], place)
        node.end[1].append((place, row))
        return False

    def terminals(self) -> Iterator[tuple[bytes, tuple, list]]:
        """Every text with its smallest id and its rows."""
        waiting: list[tuple[tuple[bytes, ...], Trie]] = [((), self)]
        while waiting:
            path, node = waiting.pop()
            if node.end is not None:
                yield b"".join(path), node.end[0], node.end[1]
            waiting.extend(((*path, label), child) for label, child in node.children.values())


def _common(label: bytes, text: bytes, at: int) -> int:
    """How many bytes the label and the text from ``at`` on share, fewer than the label has."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


def _place(doc_id) -> tuple:
    """Ids in order, null as the largest."""
    return (doc_id is None, doc_id)


def failures(text: Column) -> Column:
    """The mask of a text's failures of filters A to D: few words, few distinct words, capitals, signs."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    failed = (n < 50, 100 * distinct < 65 * n, 100 * capitals.cast("bigint") > 5 * F.length(text), text.rlike(r"[#$%&*|]"))
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(failed)), F.lit(0))


class _Rows:
    """Rows collected into record batches of bounded size."""

    def __init__(self, id_type: pa.DataType, *more: tuple[str, pa.DataType]):
        fields = [("doc_id", id_type), ("part", pa.string()), ("mask", pa.int32()), *more]
        self.schema, self.rows, self.size = pa.schema(fields), [], 0

    def add(self, row: tuple, size: int = 0) -> bool:
        self.rows.append(row)
        self.size += size
        return self.size >= BATCH_BYTES or len(self.rows) >= BATCH_ROWS

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(self.schema)
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
        self.rows, self.size = [], 0
        return out


def _inserted(batches: Iterator[pa.RecordBatch], together: str | None) -> Iterator[tuple[pa.DataType, Iterator[tuple[bytes, tuple, list]]]]:
    """The terminals of one trie after the other, each full, and not left between rows equal in the column ``together``."""
    trie, held, rows, last, kind = Trie(), 0, 0, None, None
    for batch in batches:
        kind = batch.column("doc_id").type
        texts, keys = batch.column("text"), batch.column(together) if together else None
        for at, (doc_id, part, mask) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "part", "mask")), strict=True)):
            if held >= TRIE_BYTES or rows >= TRIE_ROWS:
                if keys is None or keys[at].as_py() != last:
                    yield kind, trie.terminals()
                    trie, held, rows = Trie(), 0, 0
            text = texts[at].as_py()
            held += len(text) * trie.insert(text, _place(doc_id), (doc_id, part, mask))
            rows += 1
            if keys is not None and (held >= TRIE_BYTES or rows >= TRIE_ROWS):
                last = keys[at].as_py()
    if kind is not None:
        yield kind, trie.terminals()


def _own_duplicates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of texts that a smaller id of the same trie has are flagged and lose the text; rows of the smallest keep it."""
    for kind, terminals in _inserted(batches, None):
        out = _Rows(kind, ("text", pa.binary()))
        for text, least, members in terminals:
            for place, (doc_id, part, mask) in members:
                known = place != least
                if out.add((doc_id, part, mask | DUPLICATE * known, None if known else text), 0 if known else len(text)):
                    yield out.batch()
        yield out.batch()


def _all_duplicates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a range, sorted by prefix, in tries that hold whole prefixes; the rows without their text, flagged where a smaller id has it."""
    for kind, terminals in _inserted(batches, "prefix"):
        out = _Rows(kind)
        for _, least, members in terminals:
            for place, (doc_id, part, mask) in members:
                if out.add((doc_id, part, mask | DUPLICATE * (place != least))):
                    yield out.batch()
        yield out.batch()


def adaptive_prefix(rows: DataFrame, part_bytes: int = PART_BYTES) -> tuple[Column, int]:
    """The prefix of ``text`` (binary) to range-partition by, and the number of ranges.

    Bytes are counted for every prefix length at once, over all rows, combined
    in each task first. A text goes by its shortest prefix that doesn't hold
    more than a range's bytes, or by the whole text; equal texts go by the same
    one. There are as many ranges as the session has shuffle partitions, or
    more, as ``part_bytes`` ask for. Only hashes of heavy prefixes reach the
    driver, at most ``HEAVY`` for each length.
    """
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(MOST_PARTS, max(least, math.ceil(total / part_bytes))))
    aimed = max(min(total // parts, part_bytes), total // HEAVY)
    cut = lambda n: F.substring(F.col("text"), F.lit(1), F.lit(n))
    hashed = lambda n: F.xxhash64(F.lit(n), cut(n))
    shorter = F.array(*(F.when(F.octet_length("text") > n, F.struct(F.lit(n).alias("n"), hashed(n).alias("h"))) for n in PREFIXES))
    sized = rows.select(F.octet_length("text").cast("bigint").alias("bytes"), F.explode(F.array_compact(shorter)).alias("p"))
    heavy: dict[int, list[int]] = {}
    for r in sized.groupBy("p").agg(F.sum("bytes").alias("bytes")).where(F.col("bytes") > aimed).select("p.n", "p.h").collect():
        heavy.setdefault(r["n"], []).append(r["h"])
    prefix = F.col("text")
    for n in reversed([n for n in PREFIXES if n <= max(heavy, default=0) * 4 or n == PREFIXES[0]]):
        goes_on = F.octet_length("text") > n
        if n in heavy:
            goes_on &= hashed(n).isin(heavy[n])
            prefix = F.when(goes_on, prefix).otherwise(cut(n))
        else:
            prefix = cut(n)
    return prefix, parts


def flagged(docs: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """``doc_id, part, mask`` for each row of ``docs(doc_id, text, source)``: the filters its whole text fails, duplicates among them.

    Each task first puts its texts into tries of its own. Rows that a smaller
    id of the task beats are decided; the rest, a row per text and task, are
    stored and meet by range of an adaptive text prefix, each prefix in one
    trie. A text that a third of all rows share is thus at most a row per task
    (and as many more as repeat the smallest id there), however frequent it is.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), failures(text).alias("mask"), F.encode(text, "UTF-8").alias("text"))
    kind = f"doc_id {id_type}, part string, mask int"
    first = written(rows.mapInArrow(_own_duplicates, f"{kind}, text binary"))
    open_rows = first.where(F.col("text").isNotNull())
    prefix, parts = adaptive_prefix(open_rows, part_bytes)
    ranged = open_rows.withColumn("prefix", prefix).repartitionByRange(parts, "prefix").sortWithinPartitions("prefix")
    return first.where(F.col("text").isNull()).drop("text").unionByName(ranged.mapInArrow(_all_duplicates, kind))


def counted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``part`` and per mask the numbers of rows (``n``), of good and of toxic ones: arrays indexed by mask.

    Rows are counted by id before they meet the labels, so an id repeated many
    times is a few rows.
    """
    label = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
        F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("bad"),
    )
    by_id = rows.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n")).join(label, "doc_id", "left")
    some = lambda flag: F.sum(F.when(F.col(flag), F.col("n")).otherwise(0))
    by_mask = by_id.groupBy("part", "mask").agg(F.sum("n").alias("n"), some("good").alias("good"), some("bad").alias("bad"))
    at = lambda c: F.array(*(F.sum(F.when(F.col("mask") == m, F.col(c)).otherwise(0)) for m in range(MASKS)))
    return by_mask.groupBy("part").agg(*(at(c).alias(c) for c in ("n", "good", "bad")))


def every_step() -> list[tuple[str, int, str, int, int]]:
    """Each order of the filters, a row per step: order, step, filter, mask of the filters before it, its own mask bit."""
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    return [
        ("".join(order), k + 1, f, sum(bit[x] for x in order[:k]), bit[f])
        for order in permutations(FILTERS)
        for k, f in enumerate(order)
    ]


def interactions(per_part: DataFrame) -> DataFrame:
    """A row per part, order and step from the counts per mask; see :func:`audited`."""
    spark = per_part.sparkSession
    orders = math.factorial(len(FILTERS))
    steps = spark.createDataFrame(every_step(), "filter_order string, step int, filter string, before int, own int")
    listed = steps.agg(F.collect_list(F.struct(*steps.columns)).alias("s")).scalar()  # 600 entries
    rows = per_part.select("*", F.explode(listed).alias("s")).select("part", "n", "good", "bad", "s.*")
    before, own = F.col("before"), F.col("own")

    def total(counts: str, test, weight=lambda m: F.lit(1)) -> Column:
        masks = F.sequence(F.lit(0), F.lit(MASKS - 1))
        return F.aggregate(masks, F.lit(0).cast("bigint"), lambda a, m: a + F.when(test(m), F.get(F.col(counts), m) * weight(m)).otherwise(0))

    fails = lambda m: m.bitwiseAND(own) != 0
    early = lambda m: m.bitwiseAND(before) != 0
    here = lambda m: fails(m) & ~early(m)
    return rows.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda m: ~fails(m) & ~early(m)).alias("kept"),
        total("n", here).alias("removed"),
        total("n", lambda m: fails(m) & early(m)).alias("redundant"),
        total("n", lambda m: m == own).alias("unique_fails"),
        total("good", here).alias("good_lost"),
        total("bad", here).alias("toxic_lost"),
        # of the filters a row fails, each comes first in an equal share of all orders
        total("n", fails, lambda m: F.floor(F.lit(orders) / F.bit_count(m)).cast("bigint")).alias("shapley"),
    )


def audited(docs: DataFrame, labels: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """What filters A to E do to ``docs(doc_id, text, source)`` in each of their 120 orders.

    A row per ``part`` (source), ``filter_order`` and ``step``: documents kept
    after the step, removed in it, redundant (failing its filter, but removed
    before), failing its filter alone (``unique_fails``), and of those removed
    the good and the toxic ones by ``labels(doc_id, quality, toxic)``;
    ``shapley`` is what its filter removes over all orders together. The orders
    are worked out from counts per set of failed filters, not from documents.

    A null text is an empty one and a null source an empty string. Filter E
    removes a row whose text a smaller id has; rows equal in id and text stay
    together, a null id counts as the largest. An id labelled more than once is
    good or toxic if any label says so; null ids have no label. An empty table
    gives no rows. Other columns are ignored.
    """
    return interactions(written(counted(flagged(docs, part_bytes), labels)))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of all documents."""
    return audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = """
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY text) AS least FROM t
),
f AS (
  SELECT doc_id, part, map {
    'A': len(words) < 50,
    'B': 100 * len(list_distinct(words)) < 65 * len(words),
    'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text),
    'D': regexp_matches(text, '[#$%&*|]'),
    'E': doc_id > least
  } AS fails FROM w
),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels GROUP BY doc_id),
d AS (SELECT f.*, coalesce(good, false) AS good, coalesce(bad, false) AS bad FROM f LEFT JOIN l USING (doc_id)),
g AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS bad FROM d GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
s AS (SELECT filter_order, step, filter_order[step] AS own, filter_order[:step - 1] AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (
  SELECT part, filter_order, step, own, n, good, bad, fails[own] AS failed,
    len(list_filter(string_split(before, ''), lambda x: x <> '' AND fails[x])) > 0 AS gone,
    len(list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: fails[x])) = 1 AS alone
  FROM g, s
),
c AS (
  SELECT part, filter_order, step, own, sum(n) FILTER (NOT failed AND NOT gone) AS kept, sum(n) FILTER (failed AND NOT gone) AS removed,
    sum(n) FILTER (failed AND gone) AS redundant, sum(n) FILTER (failed AND alone) AS unique_fails,
    sum(good) FILTER (failed AND NOT gone) AS good_lost, sum(bad) FILTER (failed AND NOT gone) AS toxic_lost
  FROM r GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0) AS kept, coalesce(removed, 0) AS removed, coalesce(redundant, 0) AS redundant,
  coalesce(unique_fails, 0) AS unique_fails, coalesce(good_lost, 0) AS good_lost, coalesce(toxic_lost, 0) AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, own), 0) AS shapley
FROM c
"""
