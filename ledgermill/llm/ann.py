"""Nearest neighbours by a hierarchical k-means tree searched best bin first."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import sampled, table, written

FIT_ROWS = 32_768
"""The tree is fitted on so many vectors at most, those with the smallest id hashes; every vector is indexed."""
LEAF_ROWS = 128
"""Vectors of a leaf aimed at; with more vectors than the sample has, leaves grow with their number."""
BRANCH = 8
CALIBRATION = 96
"""Queries whose exact neighbours say how many leaves to visit."""
RECALL = 0.95
"""Recall the visits are widened to on the calibration queries."""
BLOCK = 8_192
"""Rows that meet queries in one task at a time: neighbouring leaves together, or a part of a larger leaf."""
COUNT = 20


@dataclass
class Tree:
    """Centres of all nodes, their children, and the leaf number of childless ones.

    Vectors are lengthened by one coordinate, so that all have the same norm
    and the largest inner product is the smallest distance.
    """

    centres: np.ndarray
    children: list[list[int]]
    leaf: list[int]
    longest: float

    @property
    def leaves(self) -> int:
        return sum(1 for c in self.children if not c)

    def lengthened(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0))
        return np.concatenate([vectors, rest[:, None]], axis=1)

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each lengthened vector: down the nearest centres."""
        at = np.zeros(len(vectors), np.int64)
        going = np.arange(len(vectors))
        while len(going):
            for node in np.unique(at[going]):
                mine = going[at[going] == node]
                kids = self.children[node]
                if kids:
                    at[mine] = np.array(kids)[_nearest(vectors[mine], self.centres[kids])]
            going = going[[bool(self.children[n]) for n in at[going]]]
        return np.array([self.leaf[n] for n in at], np.int64) if len(at) else at

    def visits(self, queries: np.ndarray, most: int, sizes: list[int] | None = None, least: int = 0) -> list[list[int]]:
        """The leaves a best-bin-first walk opens for each lengthened query, in order: ``most``, or more until they hold ``least`` rows."""
        all_far = (self.centres**2).sum(axis=1) - 2 * queries @ self.centres.T
        return [self._walk(far, most, sizes or [0] * self.leaves, least) for far in all_far.tolist()]

    def _walk(self, far: list[float], most: int, sizes: list[int], least: int) -> list[int]:
        waiting, out, held = [(0.0, 0)], [], 0
        while waiting and (len(out) < most or held < least):
            node = heapq.heappop(waiting)[1]
            while kids := self.children[node]:
                node = min(kids, key=far.__getitem__)
                for kid in kids:
                    if kid != node:
                        heapq.heappush(waiting, (far[kid], kid))
            out.append(self.leaf[node])
            held += sizes[self.leaf[node]]
        return out


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1)


def k_means(vectors: np.ndarray, k: int, rounds: int = 10) -> tuple[np.ndarray, np.ndarray]:
    """Centres from evenly spread starting rows, and each row's centre; empty centres are dropped."""
    rng = np.random.default_rng(len(vectors))
    centres = vectors[rng.choice(len(vectors), min(k, len(vectors)), replace=False)]
    near = _nearest(vectors, centres)
    for _ in range(rounds):
        used = np.unique(near)
        centres = np.stack([vectors[near == c].mean(axis=0) for c in used])
        before, near = near, _nearest(vectors, centres)
        if len(used) == len(np.unique(before)) and np.array_equal(np.searchsorted(used, before), near):
            break
    used = np.unique(near)
    return centres[used], np.searchsorted(used, near)


def fit(sample: np.ndarray, longest: float, leaf_rows: int, branch: int = BRANCH) -> Tree:
    """Split the sample into ``branch`` clusters again and again, until they hold ``leaf_rows`` or can't be told apart."""
    tree = Tree(np.empty((0, 0)), [], [], longest)
    vectors = tree.lengthened(sample)
    centres = [vectors.mean(axis=0)]
    tree.children.append([])
    work = [(0, vectors)]
    while work:
        node, own = work.pop()
        if len(own) <= leaf_rows:
            continue
        found, near = k_means(own, branch)
        if len(found) < 2:
            continue
        for c in range(len(found)):
            tree.children[node].append(len(centres))
            centres.append(found[c])
            tree.children.append([])
            work.append((len(centres) - 1, own[near == c]))
    tree.centres = np.stack(centres)
    tree.leaf = [-1] * len(centres)
    walk, leaf = [0], 0  # neighbours in the tree get neighbouring numbers
    while walk:
        node = walk.pop()
        walk.extend(tree.children[node])
        if not tree.children[node]:
            tree.leaf[node], leaf = leaf, leaf + 1
    return tree


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` of the vectors that take part: all numbers finite, not all zero, not null."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    return vectors.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite & some
    )


def _best(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, count: int, seen: np.ndarray | None = None) -> list[tuple]:
    """``query_id, vec_id, score`` of each query's ``count`` best rows, ties to the smaller id.

    A product of matrices finds who may be among them; their scores are then
    worked out pair by pair, so equal vectors have equal scores.
    """
    out = []
    rough = queries @ rows.T
    for k, q in enumerate(queries):
        own = row_ids != query_ids[k]
        if seen is not None:
            own &= seen[k]
        scores = np.where(own, rough[k], -np.inf)
        if len(rows) > count:
            least = np.partition(scores, -count)[-count]
            near = np.flatnonzero(own & (rough[k] >= least - 1e-9 * (1 + abs(least)))) if np.isfinite(least) else np.flatnonzero(own)
        else:
            near = np.flatnonzero(own)
        exact = np.einsum("ij,j->i", rows[near], q)
        order = np.lexsort((row_ids[near], -exact))[:count]
        out.extend((int(query_ids[k]), int(row_ids[near[i]]), float(exact[i])) for i in order)
    return out


_FOUND = "query_id bigint, vec_id bigint, score double"


def _frame(found: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def _top(found: DataFrame, count: int) -> DataFrame:
    """The best ``count`` of each query: a bounded list, combined before the shuffle."""
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id")))
    ranked = found.groupBy("query_id").agg(F.slice(best, 1, count).alias("best"))
    return ranked.select("query_id", F.posexplode("best").alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.far")).alias("score")
    )


def exact(rows: DataFrame, queries: tuple[np.ndarray, np.ndarray], width: int, count: int = COUNT) -> DataFrame:
    """The true neighbours of a few queries (ids and vectors): every task compares its rows with all of them."""
    ids, vectors = queries

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _best(vectors, ids, _matrix(batch.column("embedding"), width), batch.column("vec_id").to_numpy(), count)
            yield pa.RecordBatch.from_pandas(_frame(found), preserve_index=False)

    return _top(rows.mapInArrow(search, _FOUND), count)


def _calibrated(tree: Tree, rows: DataFrame, sample: tuple[np.ndarray, np.ndarray], width: int, count: int, recall: float) -> int:
    """The smallest number of leaf visits (by steps of a quarter) that reaches the recall on the sample's true neighbours."""
    ids, vectors = sample
    true = exact(rows, sample, width, count).select("query_id", "vec_id")
    found = true.join(rows.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").collect()  # count rows a query
    place = {int(i): k for k, i in enumerate(ids)}
    walks = tree.visits(_flat(vectors), tree.leaves)
    order = [{leaf: k for k, leaf in enumerate(w)} for w in walks]
    at = np.array([order[place[r["query_id"]]][r["leaf"]] for r in found] or [0])
    visits = 1
    while (at < visits).mean() < recall and visits < tree.leaves:
        visits = min(tree.leaves, max(visits + 1, visits * 5 // 4))
    return visits


def _flat(queries: np.ndarray) -> np.ndarray:
    """Queries have 0 for the added coordinate."""
    return np.c_[queries, np.zeros(len(queries))]


def _blocks(sizes: dict[int, int], leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each leaf: neighbouring leaves fill a block, a larger leaf takes several."""
    first, number = np.zeros(leaves, np.int64), np.ones(leaves, np.int64)
    block, held = 0, 0
    for leaf in range(leaves):
        size = sizes.get(leaf, 0)
        if held and held + size > BLOCK:
            block, held = block + 1, 0
        first[leaf], number[leaf] = block, max(1, math.ceil(size / BLOCK))
        if number[leaf] > 1:
            block, held = block + number[leaf], 0
        else:
            held += size
    return first, number


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    count: int = COUNT,
    recall: float = RECALL,
    fit_rows: int = FIT_ROWS,
    leaf_rows: int = LEAF_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: near each query's ``count`` largest inner products among ``vectors``.

    Both tables have ``vec_id, embedding``; a row is never its own neighbour.
    A hierarchical k-means tree is fitted on at most ``fit_rows`` vectors and
    sent to all tasks (its size is bounded by that sample). Every vector goes
    to a leaf; every query walks the tree best bin first, through a priority
    queue, and opens as many leaves as brought the mean recall on
    ``CALIBRATION`` queries up to ``recall`` against their true neighbours.
    Leaf and queries meet in blocks of ``BLOCK`` rows, so a leaf may hold any share of the table.

    Vectors that are null, zero or hold a null or non-finite number take no
    part, nor do rows with a null id; a vector of another length than the
    first one's is an error. A walk goes on until its leaves hold ``count``
    candidates; with fewer in the table all are returned. Equal
    scores go to the smaller id; a repeated id counts as often as it occurs.
    An empty table gives no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows, asked = written(usable(vectors)), usable(queries)
    row = rows.agg(
        F.count("*").alias("n"), F.max(F.size("embedding")).alias("width"), F.min(F.size("embedding")).alias("least"),
        F.sqrt(F.max(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).alias("longest"),
    ).first()
    if not row["n"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if row["width"] != row["least"]:
        raise ValueError(f"vectors have {row['least']} to {row['width']} numbers")
    width, kind = row["width"], vectors.schema["embedding"].dataType.simpleString()
    sample = _local(sampled(rows, "vec_id", fit_rows), width)[1]
    tree = fit(sample, row["longest"] * (1 + 1e-9), max(1, min(leaf_rows, len(sample))))
    sent = spark.sparkContext.broadcast((tree.centres, tree.children, tree.leaf, tree.longest))
    placed = written(rows.mapInArrow(_placing(sent, width), f"vec_id bigint, embedding {kind}, leaf bigint"))
    some = _local(sampled(asked, "vec_id", CALIBRATION, seed=1), width)
    visits = _calibrated(tree, placed, some, width, count, recall) if len(some[0]) else 1
    sizes = dict(placed.groupBy("leaf").count().collect())  # a row per leaf, no more than the fitted sample
    first, number = _blocks(sizes, tree.leaves)
    where = spark.createDataFrame([(k, int(first[k]), int(number[k])) for k in range(tree.leaves)], "leaf bigint, first bigint, number bigint")
    turns = max(1, math.ceil(asked.count() / BLOCK))
    block = F.col("first") + F.pmod(F.xxhash64("vec_id"), "number")
    left = placed.join(F.broadcast(where), "leaf").select(
        block.alias("block"), "vec_id", "embedding", "leaf", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))).alias("turn")
    )
    opened = asked.mapInArrow(
        _visiting(sent, width, visits, [sizes.get(k, 0) for k in range(tree.leaves)], count + 1, first, number),
        f"query_id bigint, query {kind}, block bigint, leaves array<bigint>"
    )
    right = opened.withColumn("turn", F.pmod(F.xxhash64("query_id"), F.lit(turns)).cast("int"))
    keys = ["block", "turn"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_searching(width, count), _FOUND)
    return _top(found, count)


def _local(df: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """A bounded sample's ids and vectors."""
    got = df.select("vec_id", "embedding").toArrow()
    return got.column("vec_id").to_numpy(), _matrix(got.column("embedding"), width) if got.num_rows else np.empty((0, width))


def _placing(sent, width: int):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree = Tree(*sent.value)
            leaf = tree.place(tree.lengthened(_matrix(batch.column("embedding"), width)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int64())], ["vec_id", "embedding", "leaf"])

    return place


def _visiting(sent, width: int, visits: int, sizes: list[int], least: int, first: np.ndarray, number: np.ndarray):
    names = ["query_id", "query", "block", "leaves"]

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Tree(*sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                which, blocks, leaves = [], [], []
                for k, walk in enumerate(tree.visits(_flat(_matrix(part.column("embedding"), width)), visits, sizes, least)):
                    opened: dict[int, list[int]] = {}
                    for leaf in walk:
                        for block in range(first[leaf], first[leaf] + number[leaf]):
                            opened.setdefault(block, []).append(leaf)
                    which += [k] * len(opened)
                    blocks += opened.keys()
                    leaves += opened.values()
                taken = pa.array(which, pa.int64())
                columns = [part.column("vec_id").take(taken), part.column("embedding").take(taken)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(blocks, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))], names)

    return visit


def _searching(width: int, count: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if rows.num_rows and queries.num_rows:
            vectors, ids, leaf = _matrix(rows.column("embedding"), width), rows.column("vec_id").to_numpy(), rows.column("leaf").to_numpy()
            for at in range(0, queries.num_rows, 256):
                part = queries.slice(at, 256)
                opened = np.zeros((part.num_rows, leaf.max() + 1), bool)
                for k, own in enumerate(part.column("leaves").to_pylist()):
                    opened[k, [x for x in own if x <= leaf.max()]] = True
                asked = _matrix(part.column("query"), width)
                found += _best(asked, part.column("query_id").to_numpy(), vectors, ids, count, opened[:, leaf])
        return pa.Table.from_pandas(_frame(found), schema=schema, preserve_index=False)

    return search


def op4_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
