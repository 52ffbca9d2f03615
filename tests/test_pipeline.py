from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fixtures.adapter import CALENDAR, VIEWS, staging_view
from ledgermill.operators import audit, facts, incremental, marts, profiling, quality
from ledgermill.plans import pipeline
from ledgermill.plans.pipeline import DWH, MART, STG, Settings
from ledgermill.schemas import DIMENSIONS, STAGING
from ledgermill.sources import raw
from ledgermill.sources.layers import Layers
from ledgermill.streaming.transactions import load_available, transaction_stream

SF = "/root/testdata/sf0.001"
KEYS = [s.surrogate_key for s in DIMENSIONS.values()]


def settings(hour, **changes):
    plan = {
        "run_ts": datetime(2009, 1, 1, hour),
        "calendar_start": CALENDAR[0],
        "calendar_end": CALENDAR[1],
        "branch_limit": 10,
        "partition_facts": False,
    }
    return Settings(**(plan | changes))


@pytest.fixture(scope="module")
def stg(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("stg")
    out = {}
    for name in VIEWS:
        staging_view(spark, SF, name).write.parquet(str(root / name))
        out[name] = spark.read.parquet(str(root / name))
    return out


def by_natural_ids(dwh):
    rows = dwh["fact_transactions"].drop("transaction_key", "loaded_at", "month_key")
    for dim, spec in DIMENSIONS.items():
        rows = rows.join(dwh[dim].select(spec.natural_key, spec.surrogate_key), spec.surrogate_key)
    return sorted(tuple(map(str, r)) for r in rows.drop(*KEYS).collect())


@pytest.fixture(scope="module")
def built(spark, stg, tmp_path_factory):
    """A refresh, then two upserts of the same batch."""
    layers = Layers(spark, str(tmp_path_factory.mktemp("lake")))
    pipeline.build_warehouse(layers, settings(1), stg)
    first = layers.tables(DWH)
    rows = by_natural_ids(first)
    counts = {t: df.count() for t, df in first.items()}
    for hour in (2, 3):
        pipeline.build_warehouse(layers, settings(hour, mode="upsert"), stg)
    return layers, rows, counts


def test_loading_a_batch_again_changes_nothing(built):
    layers, rows, counts = built
    again = layers.tables(DWH)
    assert by_natural_ids(again) == rows
    assert {t: again[t].count() for t in counts} == counts


def test_upsert_needs_a_published_warehouse(spark, stg, tmp_path):
    layers = Layers(spark, str(tmp_path))
    with pytest.raises(ValueError, match="no warehouse is published"):
        pipeline.build_warehouse(layers, settings(1, mode="upsert"), stg)


def test_partitioned_facts_hold_the_same_rows(spark, stg, tmp_path, built):
    layers = Layers(spark, str(tmp_path))
    pipeline.build_warehouse(layers, settings(1, partition_facts=True), stg)
    assert "month_key" in layers.read(DWH, "fact_transactions").columns
    assert by_natural_ids(layers.tables(DWH)) == built[1]


def test_failed_upsert_leaves_the_old_warehouse(spark, stg, tmp_path, monkeypatch):
    layers = Layers(spark, str(tmp_path))
    few = stg | {"stg_merchants": stg["stg_merchants"].limit(1), "stg_transactions": stg["stg_transactions"].limit(50)}
    pipeline.build_warehouse(layers, settings(1), few)
    before = {t: df.count() for t, df in layers.tables(DWH).items()}

    def killed(*_):
        raise RuntimeError("killed between dimensions and facts")

    monkeypatch.setattr(pipeline, "write_fact", killed)
    with pytest.raises(RuntimeError, match="killed"):
        pipeline.build_warehouse(layers, settings(2, mode="upsert"), stg)
    stored = Layers(spark, str(tmp_path)).tables(DWH)
    assert {t: df.count() for t, df in stored.items()} == before
    monkeypatch.undo()
    pipeline.build_warehouse(Layers(spark, str(tmp_path)), settings(3, mode="upsert"), stg)
    after = Layers(spark, str(tmp_path)).tables(DWH)
    keys = after["fact_transactions"].agg(F.count("*"), F.count_distinct("transaction_key"), F.count_distinct("transaction_id")).first()
    assert keys[0] == keys[1] == keys[2] > before["fact_transactions"]


def test_dates_outside_the_calendar_are_set_aside(spark, stg, tmp_path, built):
    layers = Layers(spark, str(tmp_path))
    short = {"calendar_end": date(1996, 12, 31), "on_missing_date": "quarantine", "on_duplicate": "quarantine"}
    counts = {r.table_name: r["rows"] for r in pipeline.build_warehouse(layers, settings(1, **short), stg).collect()}
    assert counts["fact_transactions"] + counts["fact_transactions_rejected"] == len(built[1])
    assert counts["fact_transactions_rejected"] > 0 and counts["fact_loans_rejected"] > 0
    assert counts["dim_card_rejected"] == 0
    aside = layers.read(DWH, "fact_transactions_rejected")
    assert aside.filter("date_key <= 19961231").isEmpty()


def test_two_batches_equal_one(spark, stg, tmp_path, built):
    cut = F.col("transaction_date") < F.lit("1998-01-01").cast("timestamp_ntz")
    layers = Layers(spark, str(tmp_path))
    early = stg | {"stg_transactions": stg["stg_transactions"].filter(cut)}
    pipeline.build_warehouse(layers, settings(1), early)
    pipeline.build_warehouse(layers, settings(2, mode="upsert"), stg)
    dwh = layers.tables(DWH)
    assert by_natural_ids(dwh) == built[1]
    keys = dwh["fact_transactions"].agg(F.count("*"), F.count_distinct("transaction_key")).first()
    assert keys[0] == keys[1]


def test_account_links_are_kept_on_request(spark, stg, tmp_path):
    nobody = stg | {"stg_accounts": stg["stg_accounts"].filter("account_id like 'S%'")}
    known = {}
    for keep in (False, True):
        layers = Layers(spark, str(tmp_path / str(keep)))
        first = stg | {"stg_transactions": stg["stg_transactions"].limit(0)}
        pipeline.build_warehouse(layers, settings(1, keep_account_links=keep), first)
        pipeline.build_warehouse(layers, settings(2, mode="upsert", keep_account_links=keep), nobody)
        dwh = layers.tables(DWH)
        customers = dwh["dim_customer"].filter("customer_id <> 'UNKNOWN'")
        known[keep] = dwh["fact_transactions"].join(customers, "customer_key", "left_semi").count()
    assert known[False] == 0 and known[True] > 0


def test_failed_refresh_leaves_the_old_warehouse(spark, stg, tmp_path):
    layers = Layers(spark, str(tmp_path))
    pipeline.build_warehouse(layers, settings(1), stg)
    before = layers.read(DWH, "fact_transactions").count()
    twice = stg | {"stg_branches": stg["stg_branches"].unionByName(stg["stg_branches"])}
    with pytest.raises(Exception, match="duplicate branch_id"):
        pipeline.build_warehouse(layers, settings(2), twice)
    assert Layers(spark, str(tmp_path)).read(DWH, "fact_transactions").count() == before


def test_amounts_reconcile(spark, stg, built):
    dwh = built[0].tables(DWH)
    frames = pipeline.mart_frames(stg, dwh, 10)
    spent = dwh["fact_transactions"].agg(F.sum("amount_usd")).first()[0]
    lent = dwh["fact_loans"].agg(F.sum("loan_amount")).first()[0]
    assert frames["merchant_analytics"].agg(F.sum("total_sales_volume_usd")).first()[0] == spent
    assert frames["daily_branch_performance"].agg(F.sum("daily_transaction_volume_usd")).first()[0] == spent * 10
    own = marts.daily_branch_by_branch(dwh["dim_date"], dwh["dim_branch"], dwh["fact_transactions"])
    assert own.agg(F.sum("daily_transaction_volume_usd")).first()[0] == spent
    assert frames["credit_risk_monitoring"].agg(F.sum("total_loan_debt_usd")).first()[0] == lent


def test_suite_finds_planted_faults(spark, stg, built):
    dwh = built[0].tables(DWH)
    tables = dwh | pipeline.mart_frames(stg, dwh, 10)
    facts_tx = tables["fact_transactions"]
    bad = tables | {
        "fact_transactions": facts_tx.unionByName(
            facts_tx.limit(3).withColumn("customer_key", F.lit(None).cast("bigint")).withColumn("amount_usd", F.lit(-1).cast("decimal(15,2)"))
        )
    }
    results = {(r.check_name, r.table_name, r.column_name): r for r in quality.run_checks(bad).collect()}
    assert results["pk_unique", "fact_transactions", "transaction_key"].bad_count == 3
    assert results["fk_transactions", "fact_transactions", "customer_key"].bad_count == 3
    assert results["amount_positive", "fact_transactions", "amount_usd"].bad_count == 3
    assert results["recon_merchant", "merchant_analytics", "total_transactions"].bad_count == 3
    assert results["fk_transactions", "fact_transactions", "merchant_key"].passed
    assert results["pk_unique", "dim_card", "card_key"].passed
    report = {r.part: r for r in quality.suite_report(quality.run_checks(bad)).collect()}
    assert len(report) == 7 and report["Fact Loans Referential Integrity"].status == "PASSED"


def test_errors_that_cancel_are_found_key_by_key(spark, stg, built):
    dwh = built[0].tables(DWH)
    expected = pipeline.mart_frames(stg, dwh, 10, datetime(2024, 1, 1))
    right = pipeline.mart_frames(stg, dwh, 10, datetime(2025, 1, 1))
    assert quality.recon_contents(right, expected).collect() == []
    rows = right["merchant_analytics"]
    one, two = (r.merchant_id for r in rows.select("merchant_id").orderBy("merchant_id").limit(2).collect())
    swapped = F.col("total_sales_volume_usd") + F.when(F.col("merchant_id") == one, 5).when(F.col("merchant_id") == two, -5).otherwise(0)
    customers = right["customer_360"]
    first = customers.agg(F.min("customer_id")).first()[0]
    wrong = {
        "merchant_analytics": rows.withColumn("total_sales_volume_usd", swapped.cast("decimal(20,2)")),
        "customer_360": customers.withColumn("email", F.when(F.col("customer_id") != first, F.col("email"))).where(F.col("customer_id") == first)
        .withColumn("email", F.lit(None).cast("string")).unionByName(customers.where(F.col("customer_id") != first)),
        "credit_risk_monitoring": right["credit_risk_monitoring"].limit(0),
    }
    found = {tuple(r) for r in quality.recon_contents(wrong, expected).collect()}
    tiers = {("credit_risk_monitoring", r.credit_risk_tier, "*", 0, 1) for r in right["credit_risk_monitoring"].collect()}
    sales = {("merchant_analytics", m, "total_sales_volume_usd", 1, 1) for m in (one, two)}
    assert found == tiers | sales | {("customer_360", first, "email", 1, 1)}


def test_marts_kept_by_sums_hold_what_the_facts_give(stg, built):
    layers = built[0]
    assert set(marts.SUMS) <= set(layers.tables(DWH))
    pipeline.build_marts(layers, settings(4, mode="upsert"), stg)
    assert pipeline.mart_differences(layers, stg).collect() == []


def test_each_mart_meets_both_sides_once(spark, stg, built):
    frames = pipeline.mart_frames(stg, built[0].tables(DWH), 10)
    only = {"merchant_analytics": frames["merchant_analytics"]}
    plan = quality.recon_contents(only, only)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [key_value") == 1 and "Join FullOuter" not in plan


def test_a_check_that_throws_is_an_error_of_its_part(spark, stg, built, tmp_path):
    dwh = built[0].tables(DWH)
    tables = dwh | pipeline.mart_frames(stg, dwh, 10) | {"fact_loans": dwh["fact_loans"].drop("loan_amount")}
    layers = Layers(spark, str(tmp_path))
    results = quality.run_parts(tables, lambda name, rows: layers.write("audit", name, rows, "1"))
    report = {r.part: r for r in quality.suite_report(results).collect()}
    assert len(report) == 7
    ranges = report["Financial Business Range Validation"]
    assert ranges.status == "ERROR" and "loan_amount" in ranges.reason
    assert report["Fact Loans Referential Integrity"].status == "PASSED"
    assert quality.suite_summary(quality.suite_report(results)).first().failed_tests >= 1


def test_whole_run_from_landed_files(spark, stg, tmp_path):
    base, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    for table in STAGING:
        raw.land(stg[f"stg_{table}"], base, table, date(2009, 1, 1))
    small = {t: 1 for t in settings(1).thresholds}
    alerts = pipeline.run_pipeline(spark, base, root, settings=settings(1, thresholds=small)).collect()
    # the fixtures hold stand-in scores and rates above the limit, so the range checks fail
    assert [(a.alert_type, a.priority) for a in alerts] == [("DATA_QUALITY_ALERT", "P2"), ("FAILURE", "P1")]
    assert "6/7 Tests Passed (1 Failed)" in alerts[0].message
    assert alerts[1].message == "QualityFailure: 1 of 7 parts of the quality suite did not pass"
    assert "Traceback" in alerts[1].stack_trace and alerts[0].stack_trace is None
    layers = Layers(spark, root)
    runs = {r.stage: r for r in pipeline.all_runs(layers).collect()}
    assert [runs[s].status for s in ("staging", "warehouse", "marts", "quality")] == ["SUCCESS"] * 3 + ["FAILED"]
    assert runs["staging"].rows == sum(t.count() for t in layers.tables(STG).values())
    assert set(layers.tables(MART)) == {
        "customer_360",
        "daily_branch_performance",
        "merchant_analytics",
        "credit_risk_monitoring",
    }
    assert pipeline.running_stages(layers).isEmpty()
    broken = pipeline.run_pipeline(spark, str(tmp_path / "nowhere"), root, settings=settings(2)).collect()
    assert [(a.alert_type, a.stage) for a in broken] == [("FAILURE", "staging")]
    assert {r.run_id for r in pipeline.all_runs(layers).collect()} == {settings(1).run_id, settings(2).run_id}


def test_demo_batch_and_reset(spark, stg, tmp_path):
    layers = Layers(spark, str(tmp_path))
    for name, rows in stg.items():
        layers.write(STG, name, rows, "0")
    layers.publish(STG, "0", list(stg))
    pipeline.build_warehouse(layers, settings(1))
    pipeline.build_marts(layers, settings(1))
    before = layers.read(DWH, "fact_transactions").count()
    changes = {r.metric: r for r in pipeline.add_demo_batch(layers, settings(2), 200).collect()}
    assert changes["total_txns"].delta == 200 and changes["demo_txns"].after == 200
    # one new day for ten branches
    assert changes["branch_rows"].delta == 10
    again = {r.metric: r for r in pipeline.add_demo_batch(layers, settings(3), 200).collect()}
    assert again["total_txns"].delta == 0
    pipeline.reset_demo(layers, settings(4))
    assert layers.read(DWH, "fact_transactions").count() == before
    demo = incremental.generate_batch(spark, layers.tables(DWH), 3).orderBy("transaction_id").collect()
    assert [(r.transaction_id, float(r.amount_usd)) for r in demo] == [
        ("TXN_DEMO_000001", 514.5),
        ("TXN_DEMO_000002", 529.0),
        ("TXN_DEMO_000003", 543.5),
    ]
    assert demo[2].transaction_date == datetime(2026, 10, 12, 10, 30, 3)


def test_stream_loads_each_id_once(spark, stg, tmp_path, built):
    dwh = built[0].tables(DWH)
    dims = {d: dwh[d] for d in (*DIMENSIONS, "dim_date")}
    by_account = dwh["account_keys"]

    def build(batch):
        return facts.build_transactions(batch, by_account, dims)

    base, target, state = (str(tmp_path / p) for p in ("raw", "fact", "state"))
    rows = stg["stg_transactions"]
    raw.land(rows.repartition(3), base, "transactions", date(2009, 1, 1))
    for _ in range(2):
        load_available(transaction_stream(spark, base, max_files=1), build, target, state).awaitTermination()
        loaded = spark.read.parquet(target)
        assert loaded.count() == loaded.select("transaction_id").distinct().count() == len(built[1])
    assert loaded.select("batch").distinct().count() == 3
    raw.land(rows.limit(10), base, "transactions", date(2009, 1, 2))
    load_available(transaction_stream(spark, base), build, target, state).awaitTermination()
    assert spark.read.parquet(target).count() == len(built[1])


def test_stream_is_as_strict_as_a_batch(spark, stg, tmp_path):
    folder = tmp_path / "raw/transactions/ingest_date=2009-01-01"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("transaction_id,merchant_id,account_id,amount_usd,transaction_date\nT1,M1,A1,1.00,2009-01-01\n")
    with pytest.raises(Exception, match="(?i)header|schema"):
        raw.read_typed(spark, str(tmp_path / "raw"), "transactions").collect()
    query = load_available(transaction_stream(spark, str(tmp_path / "raw")), lambda b: b, str(tmp_path / "f"), str(tmp_path / "c"))
    with pytest.raises(Exception, match="(?i)header|schema"):
        query.awaitTermination()


def test_alerts(spark):
    events = spark.createDataFrame(
        [
            ("success", None, None, 12.345, 1000, date(2024, 1, 2), 7, [], None),
            ("WARNING", "Data Quality Suite", None, None, None, None, 7, [("Ranges", "3 bad"), (None, None)], None),
            ("FAILURE", "x" * 200, "boom", None, None, None, None, None, "Traceback\nboom"),
            (None, None, None, None, None, None, None, None, None),
        ],
        audit.EVENT_SCHEMA,
    )
    ok, warn, fail, empty = audit.alert_rows(events).collect()
    assert (ok.priority, ok.subject) == ("P3", "✅ [PIPELINE SUCCESS] Banking DWH Ingestion Batch Completed (2024-01-02)")
    assert ok.message == "1000 rows loaded in 12.35 seconds, 7/7 tests passed" or "12.34" in ok.message
    assert warn.priority == "P2" and "(2 tests failed)" in warn.subject
    assert warn.message == "5/7 Tests Passed (2 Failed)\n- Ranges: 3 bad\n- Test: Check failed"
    assert fail.priority == "P1" and len(fail.subject) == 100 and fail.message == "boom"
    assert fail.stack_trace == "Traceback\nboom" and ok.stack_trace is None
    assert (empty.alert_type, empty.priority, empty.stage) == ("FAILURE", "P1", "UNKNOWN_STAGE")


def test_log_lines(spark):
    lines = ["INIT_START v1", "START r", "END r", "REPORT r 3 ms ", "an ERROR", "SomeException: x", "done", "x REPORT"]
    rows = spark.createDataFrame([(x,) for x in lines], "value string")
    assert [tuple(r) for r in audit.classify_log(rows).collect()] == [
        ("REPORT r 3 ms", "metric"),
        ("an ERROR", "error"),
        ("SomeException: x", "error"),
        ("done", "info"),
        ("x REPORT", "info"),
    ]


def test_profiles_of_empty_tables(spark):
    empty = spark.createDataFrame([], "a string, b int")
    rows = profiling.null_or_blank(empty, "t", ("a", "b")).collect()
    assert [(r.column_name, r.null_count, r.null_percent) for r in rows] == [("a", 0, 0.0), ("b", 0, 0.0)]
    sample = profiling.schema_sample(spark, {"t": empty}).first()
    assert (sample.column_count, sample.column_names, sample.sample_rows) == (2, "a, b", [])
