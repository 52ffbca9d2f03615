"""Run registered queries against their oracles: python -m fixtures.check [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb
from pyspark.sql import SparkSession

from fixtures import oracles, registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plain(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else repr(value)
    return "null" if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str, float]:
    started = time.time()
    got = registry.registered()[name](spark, sf_dir)
    left = rows_of(got.columns, [tuple(r) for r in got.collect()])
    seconds = time.time() - started
    sql = oracles.all_oracles().get(name)
    if sql is None:
        return True, f"{len(left[1])} rows, no oracle", seconds
    answer = con.execute(sql)
    right = rows_of([d[0] for d in answer.description], answer.fetchall())
    if left == right:
        return True, f"{len(left[1])} rows", seconds
    if left[0] != right[0]:
        return False, f"columns {left[0]} / {right[0]}", seconds
    only_left = [r for r in left[1] if r not in set(right[1])][:3]
    only_right = [r for r in right[1] if r not in set(left[1])][:3]
    return False, f"{len(left[1])}/{len(right[1])} rows\n  spark {only_left}\n  duck  {only_right}", seconds


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    names = sys.argv[2:] or list(registry.REGISTRY)
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = session(), duck(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        try:
            ok, note, seconds = compare(spark, con, name, sf_dir)
        except Exception as error:
            ok, note, seconds = False, "".join(traceback.format_exception_only(error))[:600], 0.0
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28} {seconds:6.2f}s  {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} match")
    return bad


if __name__ == "__main__":
    sys.exit(main())
