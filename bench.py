"""Time the headline work at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

``build_*`` entries write a layer's table from the layer below; the other
entries run a registered query over the written tables to its last row.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from fixtures import registry
from fixtures.workbench import workbench

BUILDS = (
    "stg_customers stg_accounts stg_cards stg_merchants stg_branches stg_loans stg_transactions "
    "dim_customer dim_account dim_card dim_merchant dim_branch dim_date account_keys "
    "fact_transactions fact_loans "
    "customer_360 daily_branch_performance merchant_analytics credit_risk_monitoring"
).split()

QUERIES = (
    "src_csv_chunked src_manifest fact_tx_build fact_loan_build fact_latest_card fact_skew_lookup fact_insert_if_absent "
    "mart_customer_360 mart_daily_branch mart_daily_branch_by_branch mart_merchant mart_credit_risk "
    "dim_scd1_upsert dim_duplicate_guard dq_pk_unique dq_fk_transactions dq_suite "
    "prof_null_blank prof_children_stats dash_exec_kpis dash_top_branches dash_top_cities dash_customer_search "
    "inc_append inc_metrics"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgermill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ledgermill-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count().collect()
    bench = workbench(spark, sf_dir)
    seconds: dict[str, float] = {}
    for table in BUILDS:
        started = time.perf_counter()
        bench[table]
        seconds[f"build_{table}"] = round(time.perf_counter() - started, 3)
    run = registry.registered()
    registry.raw_base(bench)
    registry.first_load(bench)
    registry.demo_batch(bench)
    for name in QUERIES:
        started = time.perf_counter()
        run[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    line = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(sf.group(1)) if sf else None,
    }
    sys.stdout.write(json.dumps(line) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
