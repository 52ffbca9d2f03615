"""Centroid clustering in integers, distances gathered from scalar lookup tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import table, written

WIDTH, CENTROIDS, ROUNDS, SCALE, SEED = 64, 40, 5, 256, 2
LARGEST = 1 << 26
"""Largest magnitude of a component's integer for which a squared distance of 511 components surely is a long."""
ROWS = 2_048
"""Vectors whose tables and sums a task holds at a time."""


def kept(vectors: DataFrame, width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """``vec_id, x``: the vectors of ``width`` finite components, each as the integer ``floor(scale * component)``."""
    if not 0 < width < 512:
        raise ValueError(f"width {width} is not between 1 and 511")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = lambda x: F.lit(float(scale)) * x.cast("double")
    too_large = F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}, so distances may not be longs"))
    whole = lambda x: F.when(F.abs(scaled(x)) <= LARGEST, F.floor(scaled(x))).otherwise(too_large.cast("bigint"))
    own = vectors.select("vec_id", "embedding").where((F.size("embedding") == width) & finite)
    return own.select("vec_id", F.transform("embedding", lambda x: whole(x).cast("int")).alias("x"))


def first_centroids(rows: DataFrame, count: int = CENTROIDS, seed: int = SEED) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``; equal ids by components, null ids last."""
    place = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.withColumn("place", place).orderBy(F.col("place").asc_nulls_last(), "x").limit(count)
    return np.array([r["x"] for r in first.select("x").collect()], np.int64)


def distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of whole vectors: a table per dimension of every value that occurs against every centroid, gathered and summed."""
    total = np.zeros((len(vectors), len(centroids)), np.int64)
    for d in range(vectors.shape[1]):
        values, at = np.unique(vectors[:, d], return_inverse=True)
        squares = (values[:, None] - centroids[None, :, d]) ** 2
        total += squares[at]
    return total


def _vectors(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, part.column("x").flatten().to_numpy().astype(np.int64).reshape(-1, width)


def _sums(centroids: np.ndarray):
    """Counts and componentwise sums by nearest centroid, a row per centroid and task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = np.zeros(len(centroids), np.int64), np.zeros_like(centroids)
        for _, vectors in _vectors(batches, centroids.shape[1]):
            near = distances(vectors, centroids).argmin(axis=1)  # the first of equal ones
            number += np.bincount(near, minlength=len(centroids))
            np.add.at(total, near, vectors)
        used = np.flatnonzero(number)
        columns = [pa.array(used, pa.int32()), pa.array(number[used]), pa.array(total[used].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "total"])

    return work


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid that is nearest to some vector becomes their componentwise floor of the mean."""
    sums = rows.select("x").mapInArrow(_sums(centroids), "cluster int, n bigint, total array<bigint>")
    by_component = sums.select("cluster", "n", F.posexplode("total").alias("d", "total")).groupBy("cluster", "d")
    new = centroids.copy()
    # a row per centroid and component, however many vectors there are
    for r in by_component.agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        new[r["cluster"], r["d"]] = r["total"] // r["n"]
    return new


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance``: the nearest centroid of each vector, the smaller number of equal ones."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, vectors in _vectors(batches, centroids.shape[1]):
            far = distances(vectors, centroids)
            near = far.argmin(axis=1)
            columns = [part.column("vec_id"), pa.array(near, pa.int32()), pa.array(far[np.arange(len(near)), near])]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    id_type = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"vec_id {id_type}, cluster int, distance bigint")


def clustered(
    vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, width: int = WIDTH, scale: int = SCALE, seed: int = SEED
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, cluster, distance`` of each vector that is kept, and the final centroids.

    Vectors are rounded to integers once and stored. Each round sends the
    centroids to all tasks (``count`` times ``width`` integers); a task adds up
    its vectors by nearest centroid, so a row per task and centroid is
    shuffled, and the sums that reach the driver are as many as the centroids'
    components. A cluster that holds a third of all vectors costs no more than
    any other. All is exact in integers, so reruns agree; a sum that is no long
    is an error, as is a component whose integer is beyond ``LARGEST``.

    Vectors that are null, of another length, or hold a null or non-finite
    component are left out. Null ids and repeated rows are vectors like others
    (null ids start no cluster while there are others); with fewer vectors than
    ``count`` there are as many centroids; an empty table gives no rows. Other
    columns are ignored.
    """
    rows = written(kept(vectors, width, scale))
    centroids = first_centroids(rows, count, seed)
    if not len(centroids):
        return rows.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), centroids.reshape(0, width)
    for _ in range(rounds):
        centroids = moved(rows, centroids)
    return written(assigned(rows, centroids)), centroids


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and distance of every vector, with the sums of distances and its centroid's digest."""
    found, centroids = clustered(table(spark, sf_dir, "embeddings"))
    named = [(k, ",".join(map(str, c))) for k, c in enumerate(centroids.tolist())]
    per_cluster = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # a row per centroid
    all_vectors = found.agg(F.sum("distance")).scalar()
    facts = (
        spark.createDataFrame(named, "cluster int, components string")
        .select("cluster", F.sha2(F.encode("components", "UTF-8"), 256).alias("centroid_sha256"))
        .join(per_cluster, "cluster")
    )
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", all_vectors.alias("inertia"), "centroid_sha256"
    )


def _oracle() -> str:
    """The rounds written out one after the other."""
    near = (
        "a{k} AS (SELECT vec_id, arg_min(c, (dist, c)) AS c, min(dist) AS dist FROM ("
        "SELECT vec_id, c, sum((v.x - m.x) * (v.x - m.x)) AS dist FROM v JOIN c{k} m USING (d) GROUP BY vec_id, c) GROUP BY vec_id)"
    )
    mean = (
        "c{n} AS (SELECT o.c, o.d, coalesce(m.x, o.x) AS x FROM c{k} o LEFT JOIN ("
        "SELECT c, d, (s - ((s % n + n) % n)) // n AS x FROM (SELECT c, d, sum(x)::BIGINT AS s, count(*) AS n FROM v JOIN a{k} USING (vec_id) GROUP BY c, d)"
        ") m USING (c, d))"
    )
    steps = [s for k in range(ROUNDS) for s in (near.format(k=k), mean.format(k=k, n=k + 1))] + [near.format(k=ROUNDS)]
    return f"""
WITH v AS (
  SELECT vec_id, unnest(range({WIDTH})) AS d, unnest(list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {WIDTH} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {WIDTH}
),
s AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c FROM (SELECT DISTINCT vec_id FROM v) QUALIFY c < {CENTROIDS}
),
c0 AS (SELECT c, d, x FROM v JOIN s USING (vec_id)),
{", ".join(steps)},
h AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c)
SELECT vec_id, c AS cluster, dist AS distance, sum(dist) OVER (PARTITION BY c) AS cluster_inertia, sum(dist) OVER () AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN h USING (c)
"""


OP12_SQL = _oracle()
