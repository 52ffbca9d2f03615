"""Written layers: parquet tables published together, so readers never see half a load."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SIDE_BY_SIDE = 4
COMPACT_FOLDERS = 16
"""Small folders of a table that are merged into one."""
SMALL_BYTES = 1 << 30
"""Folders below this are small."""
_RELEASE = "layer string, run_id string, table_name string, paths array<string>, schema string, rows array<bigint>"


class Layers:
    """Tables under ``<root>/<layer>/<table>/<run>`` with a list of published runs.

    A load writes every table of a layer to a new folder of its run and
    publishes them at the end by one small file, which names the folders that
    make up each table: one for a table written whole, the earlier ones and a
    new one for rows added. Until then readers keep the run before. A run's
    table is written once: publishing it closes it. Run ids must sort in the
    order of the runs (a UTC timestamp does). Folders are kept relative to the
    root, so the whole tree may move.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._current: dict[str, dict[str, tuple[str, ...]]] = {}
        self._schemas: dict[tuple[str, ...], StructType] = {}
        self._rows: dict[str, int] = {}

    def path(self, layer: str, table: str, run_id: str) -> str:
        return f"{layer}/{table}/run={run_id}"

    def write(
        self, layer: str, table: str, rows: DataFrame, run_id: str, partition_by: str | None = None
    ) -> DataFrame:
        """Write one table of a run (not yet published) and return it as stored.

        Its rows are counted as they are written, which :meth:`row_counts` tells.
        """
        target = self.path(layer, table, run_id)
        if target in self._published(layer).get(table, ()):
            raise ValueError(f"run {run_id} of {layer}.{table} is published")
        seen = Observation()
        writer = rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{self.root}/{target}")
        self._rows[target] = seen.get["rows"]
        self._schemas[(target,)] = rows.schema
        return self._open((target,))

    def _open(self, paths: tuple[str, ...]) -> DataFrame:
        full = [f"{self.root}/{p}" for p in paths]
        schema = self._schemas[paths] = self._schema(paths) or self.spark.read.parquet(full[0]).schema
        if len(full) == 1:
            return self.spark.read.schema(schema).parquet(*full)
        # folders of several runs may be partitioned below, so the run is taken for a partition column too
        rows = self.spark.read.schema(schema).option("basePath", full[0].rpartition("/")[0]).parquet(*full)
        return rows.select(*schema.names)

    def _schema(self, paths: tuple[str, ...]) -> StructType | None:
        """What is known of a table's columns; a folder without rows can't tell them."""
        return next((self._schemas[p] for p in (paths, *((p,) for p in paths)) if p in self._schemas), None)

    def publish(
        self,
        layer: str,
        run_id: str,
        tables: list[str],
        added: tuple[str, ...] = (),
        merged: dict[str, tuple[str, ...]] | None = None,
    ) -> None:
        """Make a run's tables the current ones, all at once; tables not named keep their last run.

        What a run wrote for a table in ``added`` joins the rows published
        before; for one in ``merged`` it takes the place of the folders named.
        """
        known = self._published(layer)
        paths = {t: (self.path(layer, t, run_id),) for t in tables}
        paths |= {t: (*known.get(t, ()), self.path(layer, t, run_id)) for t in added}
        for t, old in (merged or {}).items():
            paths[t] = (*(p for p in known[t] if p not in old), self.path(layer, t, run_id))
        schemas = {t: self._schema(p) or self._schema(known.get(t, ())) for t, p in paths.items()}
        self._schemas |= {paths[t]: schema for t, schema in schemas.items() if schema}
        entries = [
            F.struct(
                F.lit(t).alias("table_name"),
                F.array(*map(F.lit, p)).alias("paths"),
                F.lit(schemas[t] and schemas[t].json()).cast("string").alias("schema"),
                F.array(*(F.lit(self._rows.get(x)).cast("bigint") for x in p)).alias("rows"),
            )
            for t, p in paths.items()
        ]
        note = self.spark.range(1, numPartitions=1).select(F.explode(F.array(*entries)).alias("x"))
        note.select(F.lit(layer).alias("layer"), F.lit(run_id).alias("run_id"), "x.*").write.mode("append").json(
            f"{self.root}/{layer}/_published/run={run_id}"
        )
        self._current[layer] = known | paths

    def folder_bytes(self, layer: str, table: str) -> dict[str, int]:
        """Folder -> bytes of its files, from the listing alone."""
        sizes = {}
        for path in self._published(layer).get(table, ()):
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
            sizes[path] = files.load(f"{self.root}/{path}").agg(F.sum("length")).first()[0] or 0
        return sizes

    def compact(
        self, layer: str, tables: dict[str, str | None], run_id: str, least: int = COMPACT_FOLDERS, small_bytes: int = SMALL_BYTES
    ) -> list[str]:
        """Write a table's small folders as one and publish it in their place; returns the tables that were merged.

        ``tables`` gives what each is partitioned by. Folders below
        ``small_bytes`` are merged once there are ``least`` of them, so a row is
        rewritten a bounded number of times before it rests in a large one, and
        a table of many small batches keeps fewer than ``least`` small folders. All
        tables are switched in one step; the old folders stay where they are,
        so readers that opened them before go on undisturbed.
        """
        merged = {}
        for table, by in tables.items():
            if len(self._published(layer).get(table, ())) < least:
                continue
            small = tuple(p for p, size in self.folder_bytes(layer, table).items() if size < small_bytes)
            if len(small) >= least:
                rows = self._open(small)
                self.write(layer, table, rows.hint("rebalance", by) if by else rows.hint("rebalance"), run_id, by)
                merged[table] = small
        if merged:
            self.publish(layer, run_id, [], merged=merged)
        return list(merged)

    def write_all(self, layer: str, tables: dict[str, DataFrame], run_id: str) -> dict[str, DataFrame]:
        """Write independent tables at the same time, so small ones do not wait for large ones."""
        with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
            jobs = {t: pool.submit(self.write, layer, t, rows, run_id) for t, rows in tables.items()}
        return {t: job.result() for t, job in jobs.items()}

    def _listed(self, layer: str) -> dict[str, tuple[str, ...]]:
        """table -> folders of its newest published run (a few rows per run); nothing if no run is published.

        Any other failure to read the list is an error: a load must not take it for an empty layer.
        """
        try:
            runs = self.spark.read.schema(_RELEASE).json(f"{self.root}/{layer}/_published/*")
            newest = runs.groupBy("table_name").agg(
                F.max_by(F.struct("paths", "schema", "rows"), F.struct("run_id", F.size("paths"))).alias("newest")
            )
            found = {}
            for table, note in newest.collect():
                found[table] = tuple(note.paths), note.schema
                self._rows |= {p: n for p, n in zip(note.paths, note.rows or ()) if n is not None}
            self._schemas |= {p: StructType.fromJson(json.loads(schema)) for p, schema in found.values() if schema}
            return {t: p for t, (p, _) in found.items()}
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return {}

    def _published(self, layer: str) -> dict[str, tuple[str, ...]]:
        if layer not in self._current:
            self._current[layer] = self._listed(layer)
        return self._current[layer]

    def refresh(self) -> None:
        """Forget what was read about runs, to see those published elsewhere."""
        self._current.clear()

    def tables(self, layer: str) -> dict[str, DataFrame]:
        return {t: self._open(p) for t, p in self._published(layer).items()}

    def read(self, layer: str, table: str) -> DataFrame:
        return self._open(self._published(layer)[table])

    def row_counts(self, layer: str, tables: list[str] | None = None) -> DataFrame:
        """``table_name, rows`` of the published tables (or those named), as counted when they were written: none is read.

        A folder whose rows weren't counted then is counted now.
        """
        known = self._published(layer)
        counts = []
        for table in known if tables is None else tables:
            for path in known[table]:
                if path not in self._rows:
                    self._rows[path] = self._open((path,)).count()
            counts.append((table, sum(self._rows[p] for p in known[table])))
        return self.spark.createDataFrame(counts, "table_name string, rows bigint")

    def has(self, layer: str, table: str) -> bool:
        return table in self._published(layer)
