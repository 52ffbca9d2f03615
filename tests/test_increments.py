"""Ids by bucket, merged folders, marts from stored sums, and the stream's state."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.operators import facts, marts
from ledgermill.operators.lookups import bucket_of, in_buckets
from ledgermill.plans import pipeline
from ledgermill.plans.pipeline import DWH
from ledgermill.sources import raw
from ledgermill.sources.layers import Layers
from ledgermill.streaming.transactions import load_available, state_partitions, transaction_stream


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def batch(spark, ids, month=1):
    rows = [(f"t{k:05d}", k % 7 + 1, 1, 1, k % 3 + 1, 1, 20240100 + month, f"{k % 50 + 1}.25", datetime(2024, month, 1, k % 24)) for k in ids]
    kinds = "transaction_id string, customer_key long, account_key long, card_key long, merchant_key long, branch_key long, date_key int, amount_usd string, transaction_date timestamp_ntz"
    return spark.createDataFrame(rows, kinds).withColumn("amount_usd", F.col("amount_usd").cast("decimal(15,2)"))


def settings(n, **changes):
    return pipeline.Settings(run_ts=datetime(2024, 1, 1 + n // 24, n % 24), **({"id_buckets": 16, "compact_folders": 100} | changes))


def load(layers, n, rows, **changes):
    s = settings(n, **changes)
    stored = layers.tables(DWH)
    if n == 0:
        layers.publish(DWH, s.run_id, pipeline.write_fact(layers, "fact_transactions", rows, s))
    else:
        names = pipeline.write_fact(layers, "fact_transactions", rows, s, stored["fact_transactions"], pipeline.known_ids("fact_transactions", stored))
        layers.publish(DWH, s.run_id, [], added=tuple(names))
        pipeline.compact_facts(layers, s)


def loaded(layers):
    return sorted((r.transaction_id, r.amount_usd) for r in layers.read(DWH, "fact_transactions").collect())


def files(layers, table):
    paths = layers._published(DWH)[table]
    return sum(len(list(Path(layers.root, p).rglob("*.parquet"))) for p in paths)


def test_only_the_buckets_of_the_batch_are_read(spark, tmp_path):
    in_buckets(batch(spark, range(2000)), "transaction_id", 16).write.partitionBy("id_bucket").parquet(str(tmp_path / "ids"))
    ids = spark.read.parquet(str(tmp_path / "ids"))
    assert ids.select("id_bucket").distinct().count() == 16
    few = batch(spark, [3, 4, 2001])
    touched = {r[0] for r in few.select(bucket_of("transaction_id", 16)).collect()}
    fresh = facts.insert_if_absent(few, ids, "transaction_id", 16)
    assert [r.transaction_id for r in fresh.collect()] == ["t02001"] and fresh.columns == few.columns
    pruned = [line for line in plan_of(fresh).splitlines() if "PartitionFilters" in line and "id_bucket" in line]
    assert pruned and all(str(b) in pruned[0] for b in touched) and len(touched) < 16
    assert facts.insert_if_absent(batch(spark, []), ids, "transaction_id", 16).collect() == []


def test_three_loads_with_repeats(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    load(layers, 0, batch(spark, range(300)))
    load(layers, 1, batch(spark, range(200, 400), 2))
    load(layers, 2, batch(spark, [*range(0, 50), *range(350, 420)], 3))
    rows = layers.read(DWH, "fact_transactions")
    assert rows.agg(F.count("*"), F.count_distinct("transaction_id"), F.count_distinct("transaction_key")).first() == (420, 420, 420)
    assert rows.where("transaction_id = 't00360'").first().date_key == 20240102  # of the load it first came with
    ids = layers.read(DWH, "fact_transactions_ids")
    assert ids.count() == ids.select("transaction_id").distinct().count() == 420
    assert layers.read(DWH, "fact_transactions_last").agg(F.max("last")).first()[0] == rows.agg(F.max("transaction_key")).first()[0]


def test_sums_of_loads_are_sums_of_all_rows(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    for n, ids in enumerate((range(200), range(150, 300), range(0, 310))):
        load(layers, n, batch(spark, ids, n + 1))
    tables = layers.tables(DWH)
    for name, keys in marts.SUMS.items():
        merged = {tuple(r) for r in marts.sums(tables[name], *keys).collect()}
        assert merged == {tuple(r) for r in marts.sums(tables["fact_transactions"], *keys).collect()}
    # a warehouse whose first load stored no sums gets none of its later loads alone
    old = Layers(spark, str(tmp_path / "old"))
    s = settings(0)
    pipeline.write_fact(old, "fact_transactions", batch(spark, range(5)), s)
    old.publish(DWH, s.run_id, ["fact_transactions"])
    load(old, 1, batch(spark, range(9)))
    assert set(old.tables(DWH)) == {"fact_transactions"} and old.read(DWH, "fact_transactions").count() == 9


def test_many_batches_leave_few_folders(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    load(layers, 0, batch(spark, range(20)))
    for n in range(1, 9):
        load(layers, n, batch(spark, range(10 * n, 10 * n + 20), 1), id_buckets=16)
    before, want = files(layers, "fact_transactions"), loaded(layers)
    reader = layers.read(DWH, "fact_transactions")  # opened before the merge
    assert set(pipeline.compact_facts(layers, settings(9, compact_folders=4))) >= {"fact_transactions", "fact_transactions_ids", "sums_by_day"}
    assert len(layers._published(DWH)["fact_transactions"]) == 1 and files(layers, "fact_transactions") < before
    assert loaded(layers) == want == sorted((r.transaction_id, r.amount_usd) for r in reader.collect())
    assert loaded(Layers(spark, str(tmp_path))) == want
    load(layers, 10, batch(spark, range(95, 110)))
    assert len(loaded(layers)) == 110
    assert pipeline.compact_facts(layers, settings(11, compact_folders=4)) == []


def test_a_first_load_without_rows(spark, tmp_path):
    load(Layers(spark, str(tmp_path)), 0, batch(spark, []))
    layers = Layers(spark, str(tmp_path))  # as another process sees it
    assert loaded(layers) == [] and layers.read(DWH, "fact_transactions_ids").columns == ["transaction_id", "id_bucket"]
    load(layers, 1, batch(spark, range(5)))
    load(Layers(spark, str(tmp_path)), 2, batch(spark, range(7)))
    assert [t for t, _ in loaded(Layers(spark, str(tmp_path)))] == [f"t{k:05d}" for k in range(7)]


def test_rows_are_counted_while_they_are_written(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    load(layers, 0, batch(spark, range(40)))
    load(layers, 1, batch(spark, range(30, 50)))
    for reader in (layers, Layers(spark, str(tmp_path))):
        counts = reader.row_counts(DWH)
        told = {r.table_name: r["rows"] for r in counts.collect()}
        assert told == {t: df.count() for t, df in reader.tables(DWH).items()} and told["fact_transactions"] == 50
        assert "FileScan" not in plan_of(counts) and "Scan parquet" not in plan_of(counts)
    later = Layers(spark, str(tmp_path))
    later._published(DWH)
    later._rows.clear()  # as with notes of loads that didn't count
    assert {r.table_name: r["rows"] for r in later.row_counts(DWH).collect()} == told


def test_large_folders_stay(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    for n in range(4):
        layers.write("x", "t", spark.range(100_000 if n == 0 else 10), f"{n}")
        layers.publish("x", f"{n}", [], added=("t",))
    assert layers.compact("x", {"t": None}, "4", least=3, small_bytes=50_000) == ["t"]
    assert layers._published("x")["t"] == (layers.path("x", "t", "0"), layers.path("x", "t", "4"))
    assert layers.read("x", "t").count() == 100_030


@pytest.fixture()
def landed(spark, tmp_path):
    """Ten files of one id range each, every one also with ids of the one before."""
    kinds = "transaction_id string, account_id string, merchant_id string, amount_usd string, transaction_date string"

    def land(n, ids, amount="1.50"):
        rows = spark.createDataFrame([(f"T{k}", "A1", "M1", amount, "2024-01-01 10:00:00") for k in ids], kinds)
        rows = rows.select(*schemas.raw_schema("transactions").names).coalesce(1)
        raw.land(rows, str(tmp_path / "raw"), "transactions", date(2024, 1, n))

    return land


def test_ten_micro_batches_and_one_again(spark, tmp_path, landed):
    for n in range(1, 11):
        landed(n, range(n * 10 - 15 if n > 1 else 0, n * 10))
    base, target, state = (str(tmp_path / p) for p in ("raw", "fact", "state"))
    plans = []

    def build(rows):
        plans.append(plan_of(rows))
        return rows

    load_available(transaction_stream(spark, base, max_files=1), build, target, state).awaitTermination()
    got = spark.read.parquet(target)
    assert sorted(r.transaction_id for r in got.collect()) == sorted(f"T{k}" for k in range(100))
    assert len(plans) == 10 and got.select("batch").distinct().count() == 10
    # the last commit is lost: that micro-batch runs again, from the state before it
    commits = sorted((int(p.name), p) for p in Path(state, "commits").glob("[0-9]*"))
    commits[-1][1].unlink()
    Path(state, "commits", f".{commits[-1][0]}.crc").unlink(missing_ok=True)
    load_available(transaction_stream(spark, base, max_files=1), build, target, state).awaitTermination()
    assert len(plans) == 11
    assert sorted(r.transaction_id for r in spark.read.parquet(target).collect()) == sorted(f"T{k}" for k in range(100))
    # earlier batches are not read: only what the trigger brought, no scan of the target
    assert not any(target in p for p in plans)
    landed(11, [3, 104], amount="-1")
    landed(12, [4, 104])
    load_available(transaction_stream(spark, base, max_files=1), build, target, state).awaitTermination()
    last = spark.read.parquet(target).where("batch >= 10").collect()
    assert [(r.transaction_id, float(r.amount_usd)) for r in last] == [("T104", 1.5)]  # an invalid row takes no id
    assert json.loads(Path(state, "metadata").read_text())["id"]


def test_ids_are_forgotten_after_the_delay(spark, tmp_path, landed):
    landed(1, [1, 2, 2])
    base, target, state = (str(tmp_path / p) for p in ("raw", "fact", "state"))
    load_available(transaction_stream(spark, base), lambda b: b, target, state, delay="30 days").awaitTermination()
    assert sorted(r.transaction_id for r in spark.read.parquet(target).collect()) == ["T1", "T2"]


def test_a_micro_batch_is_read_and_looked_up_once(spark, tmp_path, landed):
    """Whatever a build runs on a batch, it runs on stored rows: not on the files and the state again."""
    landed(1, range(20))
    landed(2, range(10, 30))
    base, target, state = (str(tmp_path / p) for p in ("raw", "fact", "state"))
    plans, counts = [], []

    def build(rows):
        plans.append(plan_of(rows))
        counts.append((rows.count(), rows.select("transaction_id").distinct().count()))
        return rows

    load_available(transaction_stream(spark, base, max_files=1), build, target, state).awaitTermination()
    assert counts == [(20, 20), (10, 10)]
    assert not any("ExistingRDD" in p or "StateStore" in p for p in plans)
    assert all("Scan parquet" in p for p in plans)
    assert spark.read.parquet(target).count() == 30


def test_ids_dealt_by_hash_before_are_dealt_evenly_again(spark, tmp_path, landed):
    assert [state_partitions(n, c) for n, c in ((100, 6), (600, 3), (8, 2), (2, 8), (1, 8))] == [23, 11, 7, 2, 1]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    landed(1, [k for k, in spark.range(2000).filter("pmod(hash(concat('T', id)), 8) = 3").collect()])
    base, target, state = (str(tmp_path / p) for p in ("raw", "fact", "state"))
    sizes = []

    def build(rows):
        sizes.extend(r["count"] for r in rows.groupBy(F.input_file_name()).count().collect())
        return rows

    load_available(transaction_stream(spark, base), build, target, state).awaitTermination()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before == "8"
    assert len(sizes) == len([p for p in Path(state, "state", "0").iterdir() if p.name.isdigit()]) == 7
    assert max(sizes) < sum(sizes) / 4


def test_texts_of_the_stream_are_cleaned_once(spark, tmp_path, landed):
    landed(1, [1])
    base, target, state = (str(tmp_path / p) for p in ("raw", "fact", "state"))
    query = load_available(transaction_stream(spark, base), lambda b: b, target, state)
    query.awaitTermination()
    plan = query._jsq.explainInternal(True).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.index("Filter") < plan.index("Generate inline") and plan.count("Filter") == 1
    assert plan.count("#N/A N/A") <= 5  # one list of missing markers for a column
