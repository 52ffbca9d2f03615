"""K-d tree partitioning of documents into shards of near equal bytes."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import numbered, table, written

HISTOGRAM_ROWS = 1 << 16
"""Most rows a round of the median search sends to the driver, over all open nodes."""
CLOSE = 0.002
"""A cut this close to its goal, as a share of the target bytes, is good enough."""
WHOLE = 0.03
"""How far a cut may miss its goal, as a share of the target bytes, to keep equal texts in one shard."""

KEYS = ("_group", "_order")
"""Behind the dimension, ties are cut by the text's hash, then by the id's hash."""


@dataclass
class Node:
    """A box of the tree: the rows it takes are those its parent's cut sends here."""

    leaves: int
    total: int = 0
    widest: list[str] = field(default_factory=list)
    cut: tuple[tuple[str, int], ...] = ()
    below: Node | None = None
    above: Node | None = None


def text_dimensions(text: Column) -> dict[str, Column]:
    """Metadata worked out from the text alone, so equal texts share every coordinate."""
    size, chars = F.octet_length(text), F.char_length(text)
    words = chars - F.char_length(F.translate(text, " \t\n", ""))
    share = lambda part, of: F.when(of > 0, part / of).otherwise(F.lit(0.0))
    scaled = lambda x, top: F.coalesce((x * (1 << 30) / top).cast("bigint"), F.lit(0))
    return {
        "length": scaled(F.log2(size + F.lit(1)), 32),
        "script": scaled(share(size - chars, size), 1),
        "spacing": scaled(share(words, chars), 1),
    }


def before(cut: Sequence[tuple[str, int]]) -> Column:
    """Rows below the cut: lexicographically less than its values."""
    (name, value), rest = cut[0], cut[1:]
    here = F.col(name) < value
    return here | ((F.col(name) == value) & before(rest)) if rest else here


def node_number(node: Node, numbers: dict[int, int]) -> Column:
    if node.below is None or node.above is None:
        return F.lit(numbers[id(node)])
    return F.when(before(node.cut), node_number(node.below, numbers)).otherwise(node_number(node.above, numbers))


def ends(node: Node) -> list[Node]:
    if node.below is None or node.above is None:
        return [node]
    return ends(node.below) + ends(node.above)


@dataclass
class Search:
    """Where the weighted median of one node is still looked for."""

    node: Node
    goal: float
    close: float
    whole: float
    dimension: int = 0
    split_groups: bool = False
    fixed: tuple[tuple[str, int], ...] = ()
    passed: int = 0
    range: tuple[int, int] | None = None

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.node.widest[self.dimension], *KEYS)

    @property
    def key(self) -> str:
        return self.keys[len(self.fixed)]

    def restart(self, dimension: int, split_groups: bool = False) -> None:
        self.dimension, self.split_groups = dimension, split_groups
        self.fixed, self.passed, self.range = (), 0, None

    def step(self, histogram: list[tuple[int, int]], low: int, width: int) -> bool:
        """Take a round's sums by bucket; True once the cut is found."""
        below = self.passed
        for bucket, weight in histogram:
            if below + weight >= self.goal or bucket == histogram[-1][0]:
                break
            below += weight
        start, after = low + bucket * width, below + weight
        value, miss = (start, self.goal - below) if self.goal - below <= after - self.goal else (start + width, after - self.goal)
        last = len(self.fixed) == len(self.keys) - 1
        limit = self.whole if self.key == "_group" and width == 1 and not self.split_groups else self.close
        if abs(miss) <= limit or (last and width == 1):
            self.node.cut = (*self.fixed, (self.key, value))
            return True
        if width > 1:
            self.range, self.passed = (start, start + width - 1), below
        elif self.key == "_group" and not self.split_groups:
            done = self.dimension + 1 == len(self.node.widest)
            self.restart(0 if done else self.dimension + 1, split_groups=done)
        else:
            self.fixed, self.passed, self.range = (*self.fixed, (self.key, start)), below, None
        return False


def kd_tree(rows: DataFrame, dimensions: Sequence[str], leaves: int | None = None, target_bytes: int | None = None) -> Node:
    """The tree over ``rows(_bytes, _group, _order, *dimensions)``, all of them bigint and not null.

    A level is cut at once. One aggregate finds each box's width along every
    dimension (relative to the whole table's) and its bytes; then rounds of
    histograms narrow down the weighted median along the widest one. A cut
    falls between coordinates; within one coordinate between texts; and within
    the copies of one text (by id) only if every dimension would otherwise miss
    its goal by more than ``WHOLE`` of a leaf. The driver holds at most
    ``HISTOGRAM_ROWS`` sums and the tree.
    """
    root = Node(1)
    stats = [F.sum("_bytes").alias("total")] + [f(d).alias(f"{n}_{d}") for d in dimensions for n, f in (("lo", F.min), ("hi", F.max))]
    whole = rows.agg(*stats).first()
    total = whole["total"] or 0
    root.total, root.leaves = total, max(1, leaves or math.ceil(total / max(1, target_bytes or 1)))
    spans = {d: max(1, (whole[f"hi_{d}"] or 0) - (whole[f"lo_{d}"] or 0)) for d in dimensions}
    target = total / root.leaves
    while open_nodes := [n for n in ends(root) if n.leaves > 1 and n.total > 0]:
        numbers = {id(n): k for k, n in enumerate(open_nodes)} | {id(n): -1 for n in ends(root) if n not in open_nodes}
        level = rows.withColumn("_node", node_number(root, numbers)).where("_node >= 0")
        searches = []
        for n in open_nodes:
            n.total = 0
        for r in level.groupBy("_node").agg(*stats).collect():
            node = open_nodes[r["_node"]]
            node.total = r["total"]
            node.widest = sorted(dimensions, key=lambda d: (-(r[f"hi_{d}"] - r[f"lo_{d}"]) / spans[d], d))  # noqa: B023
            left = node.leaves // 2
            searches.append(Search(node, node.total * left / node.leaves, CLOSE * target * left, WHOLE * target * left))
        buckets = max(16, HISTOGRAM_ROWS // max(1, len(searches)))
        active = searches
        while active:
            number = lambda s: numbers[id(s.node)]  # noqa: E731, B023
            at = lambda s: (F.col("_node") == number(s)) & _all(F.col(k) == v for k, v in s.fixed)
            unset = [s for s in active if s.range is None]
            if unset:
                key = _case((at(s), F.col(s.key)) for s in unset)
                found = level.select("_node", key.alias("key")).where("key IS NOT NULL").groupBy("_node").agg(F.min("key"), F.max("key"))
                limits = {r[0]: (r[1], r[2]) for r in found.collect()}
                for s in unset:
                    s.range = limits[number(s)]
            widths = {number(s): max(1, -(-(s.range[1] - s.range[0] + 1) // buckets)) for s in active}
            inside = lambda s: at(s) & F.col(s.key).between(*s.range)
            bucket = _case((inside(s), F.expr(f"(`{s.key}` - ({s.range[0]}L)) div {widths[number(s)]}L")) for s in active)
            sums: dict[int, list[tuple[int, int]]] = {}
            counted = level.select("_node", "_bytes", bucket.alias("bucket")).where("bucket IS NOT NULL")
            for r in counted.groupBy("_node", "bucket").agg(F.sum("_bytes").alias("weight")).collect():
                sums.setdefault(r["_node"], []).append((r["bucket"], r["weight"]))
            active = [s for s in active if not s.step(sorted(sums[number(s)]), s.range[0], widths[number(s)])]
        for s in searches:
            half = s.node.leaves // 2
            s.node.below, s.node.above = Node(half, 1), Node(s.node.leaves - half, 1)
    return root


def _all(conditions) -> Column:
    found = F.lit(True)
    for c in conditions:
        found = found & c
    return found


def _case(branches) -> Column:
    out = None
    for when, then in branches:
        out = F.when(when, then) if out is None else out.when(when, then)
    return out


def _measured(docs: DataFrame, dimensions: dict[str, Column] | None) -> tuple[DataFrame, list[str]]:
    text = F.coalesce("text", F.lit(""))
    coordinates = dimensions or text_dimensions(text)
    measures = {
        "_bytes": (F.octet_length(text) + 1).cast("bigint"),
        "_group": F.shiftright(F.xxhash64(text), 2),
        "_order": F.shiftright(F.xxhash64("doc_id"), 2),
    }
    measures |= {f"_dim_{n}": F.coalesce(c.cast("bigint"), F.lit(0)) for n, c in coordinates.items()}
    return docs.withColumns(measures), list(measures)


def _leaf(rows: DataFrame, measures: list[str], shards: int | None, target_bytes: int | None) -> Column:
    tree = kd_tree(rows, measures[3:], shards, target_bytes)
    return node_number(tree, {id(n): k for k, n in enumerate(ends(tree))}).cast("int")


def kd_shards(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: dict[str, Column] | None = None,
) -> DataFrame:
    """Put ``docs(doc_id, text)`` into shards of near equal bytes: ``doc_id, size, text_crc32, shard, slot``.

    ``size`` is the text's UTF-8 bytes plus 1. Give the number of shards or the
    bytes a leaf should reach. ``dimensions`` are bigint columns over ``docs``;
    by default they come from the text, so copies of a text share a shard
    wherever that leaves sizes near equal. ``slot`` numbers a shard's rows from
    0 without gaps.

    A null text counts as an empty one (size 1); null coordinates as 0; a null
    id is placed like any other; repeated rows are all kept, each with its own
    slot, and numbered in many tasks however many share an id; an empty table
    gives no rows. Only the texts' measures are shuffled or written. Columns other than those named are ignored.
    """
    measured, names = _measured(docs, dimensions)
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    rows = written(measured.select("doc_id", crc.alias("text_crc32"), *names))
    placed = rows.select("doc_id", F.col("_bytes").alias("size"), "text_crc32", _leaf(rows, names, shards, target_bytes).alias("shard"))
    # rows of one id, null ones too, are spread by their place in the written table
    spread = placed.withColumn("_place", F.monotonically_increasing_id())
    return numbered(spread, "shard", ["doc_id", "text_crc32", "_place"], "slot").drop("_place")


def sharded(
    docs: DataFrame,
    shards: int | None = None,
    target_bytes: int | None = None,
    dimensions: dict[str, Column] | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` with their ``shard``, worked out as ``kd_shards`` does.

    A column of that name is replaced; ``dimensions`` are over ``doc_id`` and ``text`` here. The tree is a bounded expression, so the texts are neither joined nor shuffled.
    """
    measured, names = _measured(docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("_doc"), "doc_id", "text"), dimensions)
    leaf = _leaf(written(measured.select(*names)), names, shards, target_bytes)
    kept = (F.col("_doc")[c].alias(c) for c in docs.columns if c != "shard")
    return measured.select(*kept, leaf.alias("shard"))


def op3_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 by the law ``bytes``."""
    found = kd_shards(table(spark, sf_dir, "documents"), shards=8)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
