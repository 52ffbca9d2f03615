"""Raw files to staging, warehouse, marts and quality report, layer by layer.

Every stage reads written tables and writes tables, so a lost executor costs
the running tasks only and no plan spans more than one layer.
"""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators import audit, dimensions, facts, incremental, marts, quality
from ledgermill.operators.keys import dense_keys, load_keys
from ledgermill.operators.lookups import BROADCAST_BYTES, in_buckets
from ledgermill.operators.staging import with_loaded_at
from ledgermill.schemas import DIMENSIONS, FACT_NATURAL_KEYS, MIN_ROWS_MARTS, MIN_ROWS_WAREHOUSE, PRIMARY_KEYS, STAGING
from ledgermill.sources import raw
from ledgermill.sources.layers import COMPACT_FOLDERS, Layers

STG, DWH, MART, AUDIT = "staging", "warehouse", "mart", "audit"
IDS = {fact: f"{fact}_ids" for fact in FACT_NATURAL_KEYS}
"""The ids of each fact, stored in folders by hash bucket."""
LAST = {fact: f"{fact}_last" for fact in FACT_NATURAL_KEYS}
"""The largest key of each load of a fact, and the number of buckets its ids are in."""
IDS_A_BUCKET, MOST_BUCKETS = 1_000_000, 4096
FACT_DATES = {"fact_transactions": "transaction_date", "fact_loans": "start_date"}


@dataclass(frozen=True)
class Settings:
    """What a run may vary; the defaults follow the full-size dataset."""

    run_ts: datetime = field(default_factory=lambda: datetime.now(timezone.utc).replace(tzinfo=None))
    calendar_start: date = date(2018, 1, 1)
    calendar_end: date = date(2030, 12, 31)
    mode: str = "refresh"  # or "upsert"
    on_duplicate: str = "raise"  # or "keep_first", "quarantine"
    on_missing_date: str = "raise"  # or "quarantine"
    on_malformed: str = "raise"  # or "quarantine": raw records of another length
    multiline: bool = False  # raw files may hold quoted line breaks
    keep_account_links: bool = False
    branch_limit: int = marts.BRANCH_LIMIT
    broadcast_bytes: int = BROADCAST_BYTES
    thresholds: dict[str, int] = field(default_factory=lambda: MIN_ROWS_WAREHOUSE | MIN_ROWS_MARTS)
    partition_facts: bool = True
    fused_checks: bool = False
    id_buckets: int | None = None  # of a fact's stored ids; by default a bucket for every million of the first load
    compact_folders: int = COMPACT_FOLDERS  # small folders of a fact that are merged into one

    @property
    def run_id(self) -> str:
        return self.run_ts.strftime("%Y%m%dT%H%M%S%fZ")

    @property
    def run_date(self) -> date:
        return self.run_ts.date()


def load_staging(layers: Layers, source: Callable[[str], DataFrame | tuple[DataFrame, DataFrame]], settings: Settings) -> DataFrame:
    """Overwrite the staging tables one by one; a failure keeps the tables already loaded.

    A source may give the records it set aside as well; they are published as
    ``stg_<table>_rejected`` together with the table, and counted in the report.
    """
    loaded = []
    for table in STAGING:
        given = source(table)
        rows, rejected = given if isinstance(given, tuple) else (given, None)
        names = [f"stg_{table}"]
        layers.write(STG, names[0], with_loaded_at(rows, settings.run_ts), settings.run_id)
        if rejected is not None:
            names.append(f"stg_{table}_rejected")
            layers.write(STG, names[1], rejected, settings.run_id)
        layers.publish(STG, settings.run_id, names)
        loaded += names
    return layers.row_counts(STG, loaded)


def _load_dims(layers: Layers, stg: dict[str, DataFrame], old: dict[str, DataFrame], s: Settings):
    def stored(name: str) -> Callable[[DataFrame], DataFrame]:
        return lambda rows: layers.write(DWH, f"{name}_new_keys", rows, s.run_id)

    rows = {
        name: dimensions.build_dimension(
            name, stg[f"stg_{spec.source}"], s.run_date, old.get(name), s.on_duplicate, stored(name)
        )
        for name, spec in DIMENSIONS.items()
    }
    if "dim_date" not in old:
        rows["dim_date"] = dimensions.build_dim_date(layers.spark, s.calendar_start, s.calendar_end)
    dims = layers.write_all(DWH, rows, s.run_id)
    return {"dim_date": old.get("dim_date")} | dims


def rejected_members(layers: Layers, stg: dict[str, DataFrame], s: Settings) -> list[str]:
    """Write down the rows that lost their natural key to another one; returns the tables written."""
    if s.on_duplicate != "quarantine":
        return []
    rows = {
        f"{name}_rejected": dimensions.rejected_members(
            dimensions.CLEANERS[name](stg[f"stg_{spec.source}"], s.run_date), spec.natural_key
        )
        for name, spec in DIMENSIONS.items()
    }
    layers.write_all(DWH, rows, s.run_id)
    return list(rows)


def divided(layers: Layers, fact: str, keyed: DataFrame, dim_date: DataFrame, s: Settings) -> tuple[DataFrame, list[str]]:
    """The rows of a fact inside the calendar; the others are written as ``<fact>_rejected``."""
    if s.on_missing_date != "quarantine":
        return keyed, []
    key = "date_key" if fact == "fact_transactions" else "start_date_key"
    arrived = layers.write(DWH, f"{fact}_keyed", keyed, s.run_id)
    layers.write(DWH, f"{fact}_rejected", facts.outside_calendar(arrived, dim_date, key), s.run_id)
    return facts.inside_calendar(arrived, dim_date, key, "quarantine"), [f"{fact}_rejected"]


def _month(fact: str, rows: DataFrame) -> DataFrame:
    return rows.withColumn("month_key", F.date_format(F.col(FACT_DATES[fact]).cast("date"), "yyyyMM").cast("int"))


def write_fact(
    layers: Layers, fact: str, batch: DataFrame, s: Settings, existing: DataFrame | None = None, ids: DataFrame | None = None
) -> list[str]:
    """Write a fact: whole for a refresh, or only the ids not stored yet; returns the tables that were written.

    An incremental batch is written down before it is compared with what is
    stored, so its size is known and a small one is sent to the stored files:
    those of its own hash buckets of ``ids``, or all of the fact's if these are
    not stored. Its fresh rows are written down as well, since numbering takes
    them twice. They go to a folder of the run; publishing it adds them to the
    fact. So do their ids, and the partial sums the marts are worked out from.
    """
    key, id_col, by = PRIMARY_KEYS[fact], FACT_NATURAL_KEYS[fact], "month_key" if s.partition_facts else None

    def laid_out(rows: DataFrame) -> DataFrame:
        return _month(fact, rows).hint("rebalance", by) if by else rows

    buckets = None
    if existing is None:
        # keys come after the last shuffle, so the task that writes a row numbers it
        rows = load_keys(laid_out(batch), key)
    else:
        if ids is None:
            last = existing.agg(F.max(key)).first()[0]
        else:
            last, buckets = layers.read(DWH, LAST[fact]).agg(F.max("last"), F.max("buckets")).first()
        arrived = layers.write(DWH, f"{fact}_batch", batch, s.run_id)
        fresh = facts.insert_if_absent(arrived, existing if ids is None else ids, id_col, buckets)
        fresh = layers.write(DWH, f"{fact}_fresh", fresh, s.run_id)
        # a batch is numbered without gaps, as it is small and there are many of them; the numbers depend on the ids
        # alone, so rows may be laid out for their files afterwards
        rows = laid_out(dense_keys(fresh, id_col, key, last or 0))
    stored = layers.write(DWH, fact, with_loaded_at(rows, s.run_ts), s.run_id, by)
    return [fact, *_write_beside(layers, fact, stored, s, existing is None, buckets)]


def _write_beside(
    layers: Layers, fact: str, stored: DataFrame, s: Settings, whole: bool, buckets: int | None = None
) -> list[str]:
    """Store what later loads and the marts need of a fact's new rows, so that neither reads the fact: see :func:`write_fact`.

    A batch is only added where the loads before it are stored as well.
    """
    last, n = stored.agg(F.max(PRIMARY_KEYS[fact]), F.count("*")).first()
    if whole:
        buckets = s.id_buckets or max(1, min(MOST_BUCKETS, n // IDS_A_BUCKET))
    noted = layers.spark.range(int(whole or n > 0), numPartitions=1)
    rows = {
        IDS[fact]: in_buckets(stored, FACT_NATURAL_KEYS[fact], buckets or 1).hint("rebalance", "id_bucket"),
        LAST[fact]: noted.select(F.lit(last or 0).cast("bigint").alias("last"), F.lit(buckets).cast("int").alias("buckets")),
    }
    if fact == "fact_transactions":
        rows |= {t: marts.sums(stored, *keys) for t, keys in marts.SUMS.items()}
    kept = {t: r for t, r in rows.items() if whole or layers.has(DWH, t)}
    for table, r in kept.items():
        layers.write(DWH, table, r, s.run_id, "id_bucket" if table == IDS[fact] else None)
    return list(kept)


def known_ids(fact: str, stored: dict[str, DataFrame]) -> DataFrame | None:
    """The ids of a fact by bucket, if all of them are stored so."""
    return stored.get(IDS[fact])


def compact_facts(layers: Layers, s: Settings) -> list[str]:
    """Merge the small folders that batches left; as a run of its own, named after the batch's."""
    by_month = "month_key" if s.partition_facts else None
    tables = {fact: by_month for fact in IDS} | {ids: "id_bucket" for ids in IDS.values()}
    tables |= {t: None for t in (*LAST.values(), *marts.SUMS)}
    return layers.compact(DWH, tables, f"{s.run_id}-merged", s.compact_folders)


def build_warehouse(layers: Layers, settings: Settings, stg: dict[str, DataFrame] | None = None) -> DataFrame:
    """Staging (the published one unless given) to star schema.

    ``refresh`` rebuilds five dimensions and two facts next to the old ones and
    switches over when all are written; the calendar is kept. ``upsert`` merges
    dimensions and adds facts whose ids are new, and switches over in one step
    as well; it needs a published warehouse. Rows that quarantine sets aside are
    published as ``<table>_rejected`` and counted in the report.
    """
    s = settings
    if s.mode not in ("refresh", "upsert"):
        raise ValueError(f"mode: {s.mode!r}")
    stg = stg or layers.tables(STG)
    stored = layers.tables(DWH)
    upsert = s.mode == "upsert"
    if upsert and "fact_transactions" not in stored:
        raise ValueError(f"no warehouse is published under {layers.root}: load it with mode='refresh' first")
    old = stored if upsert else {k: v for k, v in stored.items() if k == "dim_date"}
    dims = _load_dims(layers, stg, old, s)
    links = None
    if s.keep_account_links and upsert and "account_links" in stored:
        links = stored["account_links"]
    owners = facts.account_owners(stg["stg_accounts"])
    if s.keep_account_links:
        if links is not None:
            kept = links.join(owners.select("account_id"), "account_id", "left_anti")
            owners = owners.unionByName(kept)
        links = layers.write(DWH, "account_links", owners, s.run_id)
    by_account = layers.write(
        DWH,
        "account_keys",
        facts.account_keys(
            stg["stg_accounts"],
            stg["stg_cards"],
            dims["dim_customer"],
            dims["dim_account"],
            dims["dim_card"],
            links,
            s.broadcast_bytes,
        ),
        s.run_id,
    )
    on_missing = "keep" if s.on_missing_date == "quarantine" else s.on_missing_date
    built = {
        "fact_transactions": facts.build_transactions(
            stg["stg_transactions"], by_account, dims, on_missing, s.broadcast_bytes
        ),
        "fact_loans": facts.build_loans(stg["stg_loans"], dims, on_missing, s.broadcast_bytes),
    }
    names = [*DIMENSIONS, *(["account_links"] if s.keep_account_links else []), "account_keys"]
    if "dim_date" not in old:
        names.append("dim_date")
    rejected = rejected_members(layers, stg, s)
    loaded = []
    for fact, rows in built.items():
        kept, aside = divided(layers, fact, rows, dims["dim_date"], s)
        loaded += write_fact(layers, fact, kept, s, *((stored[fact], known_ids(fact, stored)) if upsert else ()))
        rejected += aside
    if upsert:
        layers.publish(DWH, s.run_id, [*names, *rejected], added=tuple(loaded))
        compact_facts(layers, s)
    else:
        layers.publish(DWH, s.run_id, [*names, *rejected, *loaded])
    return layers.row_counts(DWH, [*PRIMARY_KEYS, *rejected])


def mart_frames(
    stg: dict[str, DataFrame], dwh: dict[str, DataFrame], branch_limit: int = marts.BRANCH_LIMIT, run_ts=None
) -> dict[str, DataFrame]:
    """The four marts, from stored partial sums of transactions where the warehouse has them, else from the fact."""
    by_customer, by_day, by_merchant = (dwh.get(t, dwh["fact_transactions"]) for t in marts.SUMS)
    return {
        "customer_360": marts.customer_360(
            dwh["dim_customer"], dwh["dim_account"], stg["stg_accounts"], by_customer, dwh["fact_loans"], run_ts
        ),
        "daily_branch_performance": marts.daily_branch_performance(dwh["dim_date"], dwh["dim_branch"], by_day, branch_limit, run_ts),
        "merchant_analytics": marts.merchant_analytics(dwh["dim_merchant"], by_merchant, run_ts),
        "credit_risk_monitoring": marts.credit_risk_monitoring(dwh["fact_loans"], dwh["dim_customer"], run_ts),
    }


def build_marts(
    layers: Layers,
    settings: Settings,
    stg: dict[str, DataFrame] | None = None,
    dwh: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Rebuild the four marts (from the published tables unless given) and switch to them together."""
    stg, dwh = stg or layers.tables(STG), dwh or layers.tables(DWH)
    frames = mart_frames(stg, dwh, settings.branch_limit, settings.run_ts)
    layers.write_all(MART, frames, settings.run_id)
    layers.publish(MART, settings.run_id, list(frames))
    return layers.row_counts(MART)


def mart_differences(layers: Layers, stg: dict[str, DataFrame] | None = None) -> DataFrame:
    """Keys and columns of the published marts that differ from a rebuild out of the whole facts.

    The stored partial sums are left aside, so a mart that was kept by them is
    held against the fact itself.
    """
    whole = {name: rows for name, rows in layers.tables(DWH).items() if name not in marts.SUMS}
    return quality.recon_contents(layers.tables(MART), mart_frames(stg or layers.tables(STG), whole))


def run_quality(layers: Layers, settings: Settings) -> DataFrame:
    """Run the suite and keep its results; returns the seven-row report.

    Parts run one after the other, so that one that throws is reported as ERROR
    and the others still run; ``fused_checks`` reads each table once instead.
    """
    tables = layers.tables(DWH) | layers.tables(MART)
    if settings.fused_checks:
        found = quality.run_checks(tables, settings.thresholds)
    else:
        found = quality.run_parts(tables, lambda name, rows: layers.write(AUDIT, name, rows, settings.run_id), settings.thresholds)
    results = layers.write(AUDIT, "quality_results", found, settings.run_id)
    report = layers.write(AUDIT, "quality_report", quality.suite_report(results), settings.run_id)
    layers.publish(AUDIT, settings.run_id, ["quality_results", "quality_report"])
    return report


class QualityFailure(Exception):
    """The suite ran and found violations."""


def run_pipeline(
    spark: SparkSession,
    raw_base: str,
    root: str,
    ingest_date: date | None = None,
    settings: Settings | None = None,
    source: str | None = None,
) -> DataFrame:
    """Run all stages, record each, and return the run's alert rows.

    With a ``source`` folder its CSV files are landed first, under the given
    date or the run's.

    A stage's record is written as RUNNING when it starts (``running_stages``)
    and replaced by its outcome at the end. A failed stage ends the run; its
    record and alert, with the stack trace, are written all the same.
    """
    s = settings or Settings()
    layers = Layers(spark, root)
    records: list[dict] = []
    day = ingest_date
    report = None

    def stage(name: str, work: Callable[[], DataFrame], rows_column: str | None = "rows") -> bool:
        started = time.time()
        record = {
            "run_id": s.run_id,
            "stage": name,
            "status": "RUNNING",
            "started_at": datetime.now(timezone.utc).replace(tzinfo=None),
        }
        audit.run_rows(spark, [record]).write.mode("append").json(f"{layers.root}/{AUDIT}/running/run={s.run_id}")
        try:
            out = work()
            if rows_column:
                set_aside = F.col("table_name").endswith("_rejected")
                record["rows"], record["rejected_rows"] = out.agg(
                    F.sum(F.when(~set_aside, F.col(rows_column))), F.sum(F.when(set_aside, F.col(rows_column)))
                ).first()
            record["status"] = "SUCCESS"
        except Exception as failure:
            record["status"] = "FAILED"
            record["error"] = f"{type(failure).__name__}: {failure}"
            record["stack_trace"] = traceback.format_exc()
        record["duration_seconds"] = time.time() - started
        records.append(record)
        return record["status"] == "SUCCESS"

    def ingest() -> DataFrame:
        nonlocal day
        day = ingest_date or s.run_date
        files = raw.ingest(spark, source, raw_base, day, s.run_id, s.multiline)
        return files.groupBy("table_name").agg(F.sum("record_count").alias("rows"))

    def staging() -> DataFrame:
        nonlocal day
        day = raw.resolve_date(spark, raw_base, day)
        if s.on_malformed not in ("raise", "quarantine"):
            raise ValueError(f"on_malformed: {s.on_malformed!r}")
        read = raw.read_typed if s.on_malformed == "raise" else raw.read_divided
        return load_staging(layers, lambda t: read(spark, raw_base, t, day, s.multiline), s)

    def checks() -> DataFrame:
        nonlocal report
        report = run_quality(layers, s)
        summary = quality.suite_summary(report).first()
        if summary.failed_tests:
            raise QualityFailure(f"{summary.failed_tests} of {summary.total_tests} parts of the quality suite did not pass")
        return report

    stages = (
        *([("ingest", ingest, "rows")] if source else []),
        ("staging", staging, "rows"),
        ("warehouse", lambda: build_warehouse(layers, s), "rows"),
        ("marts", lambda: build_marts(layers, s), "rows"),
        ("quality", checks, None),
    )
    for name, work, rows_column in stages:
        if not stage(name, work, rows_column):
            break
    if report is None:
        report = spark.createDataFrame([], "part string, checks long, failed_checks long, reason string, status string")
    runs = layers.write(AUDIT, "runs", audit.run_rows(spark, records), s.run_id)
    alerts = audit.alert_rows(audit.events_from_run(runs, report, day or s.run_date))
    stored = layers.write(AUDIT, "alerts", alerts, s.run_id)
    layers.publish(AUDIT, s.run_id, ["runs", "alerts"])
    return stored


def all_runs(layers: Layers) -> DataFrame:
    """The run audit: stage records of every run."""
    return layers.spark.read.parquet(f"{layers.root}/{AUDIT}/runs")


def running_stages(layers: Layers) -> DataFrame:
    """Stages that started and have no outcome yet, as after a driver that was lost."""
    started = layers.spark.read.schema(audit.RUN_SCHEMA).json(f"{layers.root}/{AUDIT}/running/*")
    try:
        ended = all_runs(layers).select("run_id", "stage")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return started
    return started.join(ended, ["run_id", "stage"], "left_anti")


def add_demo_batch(layers: Layers, settings: Settings, rows: int = incremental.DEMO_ROWS) -> DataFrame:
    """Append the demonstration batch, rebuild the marts, and compare before and after."""
    dwh, mart = layers.tables(DWH), layers.tables(MART)

    def snapshot(tables: dict[str, DataFrame], name: str) -> DataFrame:
        rows = incremental.metrics(
            tables["fact_transactions"], tables["customer_360"], tables["daily_branch_performance"]
        )
        return layers.write(AUDIT, name, rows, settings.run_id)

    before = snapshot(dwh | mart, "metrics_before")
    days = dimensions.missing_dates(dwh["dim_date"], incremental.demo_dates(layers.spark))
    layers.write(DWH, "dim_date", days, settings.run_id)
    batch = facts.one_of_each(incremental.generate_batch(layers.spark, dwh, rows), "transaction_id")
    loaded = write_fact(
        layers, "fact_transactions", batch, settings, dwh["fact_transactions"], known_ids("fact_transactions", dwh)
    )
    layers.publish(DWH, settings.run_id, [], added=("dim_date", *loaded))
    compact_facts(layers, settings)
    build_marts(layers, settings)
    after = snapshot(layers.tables(DWH) | layers.tables(MART), "metrics_after")
    return incremental.compare(before, after)


def reset_demo(layers: Layers, settings: Settings) -> None:
    """Rewrite the fact without demonstration rows, then rebuild the marts."""
    by = "month_key" if settings.partition_facts else None
    kept = incremental.without_demo(layers.read(DWH, "fact_transactions"))
    if by:
        kept = kept.hint("rebalance", by)
    stored = layers.write(DWH, "fact_transactions", kept, settings.run_id, by)
    beside = _write_beside(layers, "fact_transactions", stored, settings, True)
    layers.publish(DWH, settings.run_id, ["fact_transactions", *beside])
    build_marts(layers, settings)
