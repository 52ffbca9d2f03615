"""The registered queries: each runs one operator over whole tables of the workbench."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fixtures.adapter import CALENDAR, RUN_DATE
from fixtures.workbench import RUN_TS, Workbench, workbench
from ledgermill import schemas
from ledgermill.functions import capitalise_words, parse_date, parse_timestamp
from ledgermill.operators import (
    audit,
    dashboard,
    dimensions,
    facts,
    incremental,
    marts,
    profiling,
    quality,
    staging,
)
from ledgermill.operators.keys import load_keys
from ledgermill.operators.lookups import in_buckets, lookup, spread_lookup
from ledgermill.plans import pipeline
from ledgermill.schemas import DIMENSIONS, PRIMARY_KEYS, STAGING
from ledgermill.sources import raw
from ledgermill.sources.layers import Layers
from ledgermill.streaming.transactions import BATCH_BROADCAST_BYTES, load_available, transaction_stream

Query = Callable[[Workbench], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return register


def portable(rows: DataFrame) -> DataFrame:
    """Column types that two engines print alike: money as double, whole numbers as
    bigint, dates and timestamps as text."""

    def plain(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            return c.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return c.cast("bigint").alias(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            return c.cast("string").alias(f.name)
        return c.alias(f.name)

    return rows.select([plain(f) for f in rows.schema.fields])


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: portable(fn(workbench(spark, sf_dir)))

    return {name: bind(fn) for name, fn in REGISTRY.items()}


# --- sources and sinks -------------------------------------------------------


def raw_base(wb: Workbench) -> str:
    def land_all(folder: str) -> None:
        for table in STAGING:
            raw.land(wb.read_once(f"stg_{table}"), folder, table, RUN_DATE)

    return wb.once("raw", land_all)


def yearly_loans(wb: Workbench) -> str:
    def land(folder: str) -> None:
        by_year = F.trunc("start_date", "year")
        raw.land(wb["stg_loans"], folder, "loans", by_year)

    return wb.once("raw_yearly", land)


def as_text(rows: DataFrame, name: str) -> DataFrame:
    """(table_name, line): each row's values side by side, nulls as a tilde."""
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in rows.columns])
    return rows.select(F.lit(name).alias("table_name"), line.alias("line"))


@query("src_csv_typed")
def _(wb):
    return quality.union_all([as_text(raw.read_typed(wb.spark, raw_base(wb), t, RUN_DATE), t) for t in STAGING])


@query("src_csv_rejected")
def _(wb):
    """Loans in files where some records have a field too many: those kept and those set aside."""

    def land(folder: str) -> None:
        rows = wb["stg_loans"].select(*(F.col(c).cast("string") for c in schemas.raw_schema("loans").names))
        last = rows.columns[-1]
        longer = F.when(F.col("loan_id").like("%7"), F.concat(F.coalesce(last, F.lit("")), F.lit(",more"))).otherwise(F.col(last))
        # without quoting, a comma in a value is a field of its own
        files = rows.withColumn(last, longer).write.option("header", True).option("quote", "")
        files.csv(f"{folder}/loans/ingest_date={RUN_DATE}")

    kept, rejected = raw.read_divided(wb.spark, wb.once("raw_malformed", land), "loans", RUN_DATE)
    return kept.select("loan_id", "loan_amount", F.lit(False).alias("rejected")).unionByName(
        rejected.select(F.col("first_field").alias("loan_id"), F.lit(True).alias("rejected")), allowMissingColumns=True
    )


@query("src_csv_chunked")
def _(wb):
    return raw.read_typed(wb.spark, raw_base(wb), "transactions", RUN_DATE)


@query("src_latest_partition")
def _(wb):
    return raw.read_typed(wb.spark, yearly_loans(wb), "loans")


@query("src_landing_write")
def _(wb):
    landed = raw.read_raw(wb.spark, yearly_loans(wb), "loans")
    return landed.groupBy("ingest_date").agg(F.count("*").alias("rows"))


@query("src_discover")
def _(wb):
    return raw.discover(wb.spark, raw_base(wb)).select("table_name").distinct()


def broken_regions(wb: Workbench) -> str:
    """One file with quoted line breaks in a folder with a blank in its name."""

    def land(folder: str) -> None:
        label = F.concat(F.col("r_name"), F.lit("\n"), F.lit("second line"))
        rows = wb.source("region").orderBy("r_regionkey").select("r_regionkey", label.alias("label"))
        rows.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{folder}/my regions")

    return wb.once("raw_regions", land)


@query("src_manifest")
def _(wb):
    files = raw.manifest_tables(wb.spark, raw_base(wb))
    tables = files.groupBy("table_name", "status").agg(
        F.sum("record_count").alias("record_count"),
        F.lit(None).cast("string").alias("checksum_sha256"),
        (F.min("file_size_bytes") > 0).alias("has_bytes"),
    )
    one = raw.manifest_tables(wb.spark, broken_regions(wb), multiline=True)
    return tables.unionByName(
        one.select("table_name", "status", "record_count", "checksum_sha256", (F.col("file_size_bytes") > 0).alias("has_bytes"))
    )


@query("src_manifest_digest")
def _(wb):
    """Digests of whole files, taken block by block: the customers' file of each nation, in order."""

    def land(folder: str) -> None:
        rows = wb.source("customer").select("c_custkey", "c_mktsegment", "c_nationkey")
        sorted_rows = rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
        sorted_rows.write.partitionBy("c_nationkey").option("header", True).csv(f"{folder}/customers")

    files = raw.manifest_tables(wb.spark, wb.once("raw_customers", land))
    nation = F.regexp_extract("path", r"c_nationkey=(\d+)", 1).cast("int").alias("nation")
    return files.select(nation, "record_count", "file_size_bytes", "content_digest")


@query("src_ingest")
def _(wb):
    """All tables found below a folder, landed, and as the batch's manifest records them."""

    def export(folder: str) -> None:
        for table in STAGING:
            wb.read_once(f"stg_{table}").write.mode("overwrite").option("header", True).csv(f"{folder}/export/{table}")

    def land(folder: str) -> None:
        raw.ingest(wb.spark, f"{wb.once('exported', export)}/export", folder, RUN_DATE, "b1")

    base = wb.once("ingested", land)
    document = wb.spark.read.json(f"{base}/manifests/manifest_b1")
    recorded = document.select("status", F.explode("tables").alias("t")).select("status", "t.table_name", "t.record_count")
    landed = [raw.read_raw(wb.spark, base, t).agg(F.count("*").alias("landed")).withColumn("table_name", F.lit(t)) for t in STAGING]
    return recorded.join(quality.union_all(landed), "table_name")


# table -> columns whose totals tell its contents
TOTALS = {
    "fact_transactions": ("amount_usd",),
    "fact_loans": ("loan_amount", "interest_rate"),
    "customer_360": (
        "total_accounts",
        "total_balance_usd",
        "total_transactions",
        "total_spend_usd",
        "active_loans_count",
        "total_loan_debt_usd",
    ),
    "daily_branch_performance": ("daily_transactions_count", "daily_transaction_volume_usd"),
    "merchant_analytics": ("total_transactions", "total_sales_volume_usd", "min_txn_amount_usd", "max_txn_amount_usd"),
    "credit_risk_monitoring": ("total_loans_originated", "total_loan_debt_usd"),
}


def contents(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column_name, rows, total) for every table, with ``*`` where no column is summed."""
    parts = []
    for name, table in tables.items():
        for column in TOTALS.get(name, ("*",)):
            total = F.lit(None) if column == "*" else F.sum(column)
            sums = table.agg(F.count("*").alias("rows"), total.cast("decimal(28,2)").alias("total"))
            parts.append(sums.select(F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "rows", "total"))
    return quality.union_all(parts)


@query("src_mart_scan")
def _(wb):
    return contents(wb.marts())


@query("snk_staging_overwrite")
def _(wb):
    layers = Layers(wb.spark, f"{wb.root}/overwrite")

    def load_twice(folder: str) -> None:
        older = wb["stg_accounts"].filter("account_id like 'S%'").withColumn("balance_usd", F.lit(1).cast("decimal(15,2)"))
        for run, rows in (("1", older), ("2", wb["stg_accounts"])):
            layers.write("staging", "stg_accounts", rows, run)
            layers.publish("staging", run, ["stg_accounts"])

    wb.once("overwrite_done", load_twice)
    return layers.read("staging", "stg_accounts")


def refreshed(wb: Workbench) -> Layers:
    """A refresh from half of the tables, then one from all of them."""
    layers = Layers(wb.spark, f"{wb.root}/refresh")

    def refresh_twice(folder: str) -> None:
        stg = wb.staging()
        older = stg | {
            "stg_transactions": stg["stg_transactions"].filter("transaction_id like '%1'"),
            "stg_loans": stg["stg_loans"].filter("loan_id like '%1'"),
            "stg_merchants": stg["stg_merchants"].filter("merchant_id like '%1'"),
        }
        for hour, rows in ((1, older), (2, stg)):
            settings = wb.settings(run_ts=RUN_TS.replace(hour=hour))
            pipeline.build_warehouse(layers, settings, rows)
            pipeline.build_marts(layers, settings, rows)

    wb.once("refresh_done", refresh_twice)
    return layers


@query("snk_warehouse_refresh")
def _(wb):
    stored = refreshed(wb).tables(pipeline.DWH)
    return contents({t: stored[t] for t in PRIMARY_KEYS})


@query("snk_mart_rebuild")
def _(wb):
    return contents(refreshed(wb).tables(pipeline.MART))


@query("snk_rowcount_report")
def _(wb):
    return audit.row_counts(wb.staging() | wb.warehouse() | wb.marts())


# --- staging clean -----------------------------------------------------------


@query("stg_trim_strings")
def _(wb):
    padded = wb["stg_customers"].select(
        "customer_id",
        F.concat(F.lit("\t "), F.col("first_name"), F.lit(" \n")).alias("first_name"),
        F.concat(F.lit("\r\n"), F.col("email"), F.lit("\t")).alias("email"),
    )
    return padded.select(
        "customer_id",
        staging.clean_text(F.col("first_name")).alias("first_name"),
        staging.clean_text(F.col("email")).alias("email"),
    )


@query("stg_parse_date")
def _(wb):
    day = F.col("o_orderdate").cast("date")
    pick = F.col("o_orderkey") % 12
    text = (
        F.when(pick == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(pick == 1, F.date_format(day, "yyyy/MM/dd"))
        .when(pick == 2, F.date_format(day, "dd-MM-yyyy"))
        .when(pick == 3, F.date_format(day, "MM/dd/yyyy"))
        .when(pick == 4, F.date_format(day, "yyyyMMdd"))
        .when(pick == 5, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 23:59:59")))
        .when(pick == 6, F.lit("soon"))
        .when(pick == 8, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" garbage")))
        .when(pick == 9, F.date_format(day, "MM/dd/yy"))
        .when(pick == 10, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 10:30 PM")))
        .when(pick == 11, F.concat(F.date_format(day, "yyyyMMdd"), F.lit(" xyz")))
    )
    return wb.source("orders").select("o_orderkey", text.alias("raw_text"), parse_date(text).alias("parsed"))


@query("stg_parse_timestamp")
def _(wb):
    moment = F.col("ts").cast("string")
    pick = F.col("event_id") % 6
    text = (
        F.when(pick == 0, moment)
        .when(pick == 1, F.regexp_replace(F.substring(moment, 1, 19), " ", "T"))
        .when(pick == 2, F.substring(moment, 1, 10))
        .when(pick == 3, F.date_format("ts", "yyyy-MM-dd hh:mm a"))
        .when(pick == 4, F.concat(F.substring(moment, 1, 19), F.lit(" junk")))
        .otherwise(F.concat(F.lit("at "), moment))
    )
    return wb.source("events").select("event_id", text.alias("raw_text"), parse_timestamp(text).alias("parsed"))


@query("stg_null_text")
def _(wb):
    pick = F.col("c_custkey") % 5
    text = (
        F.when(pick == 0, F.lit("NA"))
        .when(pick == 1, F.lit("nan"))
        .when(pick == 2, F.lit(""))
        .when(pick == 3, F.col("c_mktsegment"))
        .otherwise(F.lit("  "))
    )
    return wb.source("customer").select("c_custkey", staging.clean_text(text).alias("cleaned"))


@query("stg_numeric_cast")
def _(wb):
    text = F.concat(F.lit(" "), F.col("l_extendedprice").cast("decimal(15,2)").cast("string"), F.lit("5"))
    rows = wb.source("lineitem").select(
        F.col("l_returnflag"), staging.number_or_fail(text, T.DecimalType(15, 2), "amount").alias("amount")
    )
    return rows.groupBy("l_returnflag").agg(
        F.sum("amount").alias("total"), F.min("amount").alias("lowest"), F.max("amount").alias("highest")
    )


# --- dimensions --------------------------------------------------------------


def _clean(dim: str) -> Query:
    return lambda wb: dimensions.CLEANERS[dim](wb[f"stg_{DIMENSIONS[dim].source}"], RUN_DATE)


for _dim in DIMENSIONS:
    REGISTRY[f"{_dim}_clean"] = _clean(_dim)


@query("dim_unknown_members")
def _(wb):
    parts = []
    for dim, spec in DIMENSIONS.items():
        row = wb[dim].filter(F.col(spec.natural_key) == "UNKNOWN")
        text = F.concat_ws("|", *[F.col(c).cast("string") for c in row.columns if c != spec.surrogate_key])
        parts.append(row.select(F.lit(dim).alias("dimension"), text.alias("member")))
    return quality.union_all(parts)


def account_holders(wb: Workbench) -> DataFrame:
    """Customers as first seen through their accounts: an older state of the dimension."""
    holders = (
        wb["stg_accounts"]
        .groupBy("customer_id")
        .agg(F.min("open_date").alias("created_at"))
        .select(
            "customer_id",
            F.lit("early").alias("first_name"),
            F.lit("holder").alias("last_name"),
            F.lit(None).cast("string").alias("email"),
            F.lit("old town").alias("city"),
            F.lit(None).cast("int").alias("credit_score"),
            "created_at",
        )
    )
    return dimensions.build_dimension("dim_customer", holders, RUN_DATE)


def upserted(wb: Workbench) -> DataFrame:
    old = wb.stored("old_dim_customer", lambda: account_holders(wb))
    return wb.stored(
        "new_dim_customer",
        lambda: dimensions.build_dimension("dim_customer", wb["stg_customers"], RUN_DATE, old, "keep_first"),
    )


@query("dim_scd1_upsert")
def _(wb):
    new = upserted(wb)
    kept = wb["old_dim_customer"].select("customer_id", F.col("customer_key").alias("old_key"))
    return new.join(kept, "customer_id", "left").select(
        "customer_id",
        "first_name",
        "last_name",
        "full_name",
        "email",
        "city",
        "credit_score",
        "created_at",
        F.coalesce(F.col("customer_key") == F.col("old_key"), F.lit(False)).alias("kept_key"),
    )


@query("dim_duplicate_guard")
def _(wb):
    """Dimension batches in which ids that end in 3 come again, merchants under another name."""
    parts = []
    for dim, spec in DIMENSIONS.items():
        key = spec.natural_key
        members = dimensions.CLEANERS[dim](wb[f"stg_{spec.source}"], RUN_DATE)
        again = members.filter(F.col(key).endswith("3"))
        if dim == "dim_merchant":
            again = again.withColumn("merchant_name", F.concat("merchant_name", F.lit(" again")))
        batch = members.unionByName(again)
        counted = batch.agg(F.count("*").alias("batch_rows"))
        kept = dimensions.one_per_id(batch, key, "quarantine").agg(F.count("*")).scalar()
        rejected = dimensions.rejected_members(batch, key).agg(F.coalesce(F.sum("copies"), F.lit(0))).scalar()
        ids = dimensions.duplicate_ids(batch, key).agg(F.count("*")).scalar()
        parts.append(
            counted.select(
                F.lit(dim).alias("dimension"),
                "batch_rows",
                kept.alias("kept_rows"),
                rejected.alias("rejected_rows"),
                ids.alias("repeated_ids"),
            )
        )
    return quality.union_all(parts)


@query("dim_surrogate_key")
def _(wb):
    tables = {**{d: wb[d] for d in DIMENSIONS}, "upserted_customer": upserted(wb)}
    parts = []
    for name, table in tables.items():
        key = F.col(table.columns[0])
        parts.append(
            table.agg(
                F.count("*").alias("members"),
                F.min(key).alias("lowest_key"),
                F.max(key).alias("highest_key"),
                F.count_distinct(key).alias("distinct_keys"),
            ).select(F.lit(name).alias("dimension"), "members", "lowest_key", "highest_key", "distinct_keys")
        )
    return quality.union_all(parts)


@query("dim_date_build")
def _(wb):
    days = wb.source("lineitem").agg(F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"))
    span = F.sequence(F.col("lo").cast("date"), F.col("hi").cast("date"), F.expr("interval 1 day"))
    return dimensions.calendar(days.select(F.explode(span).alias("full_date")))


@query("dim_date_ensure")
def _(wb):
    short = dimensions.build_dim_date(wb.spark, CALENDAR[0], date(1997, 12, 31))
    return dimensions.ensure_dates(short, wb["stg_transactions"].select("transaction_date"))


# --- facts -------------------------------------------------------------------


def natural(rows: DataFrame, wb: Workbench, *dims: str) -> DataFrame:
    """Surrogate keys turned back into natural ids (the UNKNOWN key may be a hot one).

    Hot keys are looked for in the rows as given, not in what was joined to them so far.
    """
    given = rows
    spread_by = next((c for c in ("transaction_id", "loan_id") if c in rows.columns), rows.columns[0])
    for dim in dims:
        spec = DIMENSIONS[dim]
        rows = lookup(rows, wb[dim].select(spec.surrogate_key, spec.natural_key), spec.surrogate_key, spread_by, given)
    return rows


TRANSACTION_IDS = ("dim_customer", "dim_account", "dim_card", "dim_merchant", "dim_branch")


def transaction_rows(rows: DataFrame, wb: Workbench | dict[str, DataFrame]) -> DataFrame:
    return natural(rows, wb, *TRANSACTION_IDS).select(
        "transaction_id",
        "customer_id",
        "account_id",
        "card_id",
        "merchant_id",
        "branch_id",
        "date_key",
        "amount_usd",
        "transaction_date",
    )


@query("fact_tx_valid")
def _(wb):
    return facts.valid_transactions(wb["stg_transactions"])


@query("fact_loan_valid")
def _(wb):
    return facts.valid_loans(wb["stg_loans"])


@query("fact_unknown_keys")
def _(wb):
    dims = {d: wb[d] for d in DIMENSIONS}
    keys = facts.unknown_keys(dims)
    parts = []
    for dim, spec in DIMENSIONS.items():
        hit = wb[dim].join(F.broadcast(keys), F.col(spec.surrogate_key) == F.col(f"unknown_{spec.surrogate_key}"))
        parts.append(hit.select(F.lit(dim).alias("dimension"), F.col(spec.natural_key).alias("natural_id")))
    return quality.union_all(parts)


@query("fact_account_customer")
def _(wb):
    known = wb["dim_customer"].select("customer_id", F.lit(True).alias("known"))
    return lookup(facts.account_owners(wb["stg_accounts"]), known, "customer_id", "account_id").select(
        "account_id", "customer_id", F.coalesce("known", F.lit(False)).alias("known_customer")
    )


@query("fact_latest_card")
def _(wb):
    return facts.latest_cards(wb["stg_cards"])


@query("fact_dim_lookup")
def _(wb):
    rows = natural(wb["fact_transactions"], wb, "dim_customer", "dim_account", "dim_card", "dim_merchant")
    found = [
        (F.col(f"{n}_id") != "UNKNOWN").alias(f"{n}_found") for n in ("customer", "account", "card", "merchant")
    ]
    return rows.groupBy(*found).agg(F.count("*").alias("transactions"), F.sum("amount_usd").alias("amount_usd"))


@query("fact_skew_lookup")
def _(wb):
    rows = facts.first_transactions(facts.valid_transactions(wb["stg_transactions"]))
    merchants = wb["dim_merchant"].select("merchant_id", "merchant_name", "city")
    return spread_lookup(rows, merchants, "merchant_id", "transaction_id", wb["stg_transactions"], hot_share=1 / 64)


@query("fact_branch_unknown")
def _(wb):
    parts = [
        natural(wb[f], wb, "dim_branch").groupBy("branch_id").agg(F.count("*").alias("rows")).select(
            F.lit(f).alias("fact"), "branch_id", "rows"
        )
        for f in ("fact_transactions", "fact_loans")
    ]
    return quality.union_all(parts)


@query("fact_date_lookup")
def _(wb):
    short = dimensions.build_dim_date(wb.spark, CALENDAR[0], date(1999, 12, 31))
    fact = wb["fact_transactions"]
    kept = facts.inside_calendar(fact, short, "date_key", "quarantine").withColumn("part", F.lit("kept"))
    rejected = facts.outside_calendar(fact, short, "date_key").withColumn("part", F.lit("rejected"))
    return kept.unionByName(rejected).groupBy("part", "date_key").agg(F.count("*").alias("rows"))


@query("fact_tx_build")
def _(wb):
    # written down, as turning keys back into ids reads the rows more than once
    return transaction_rows(wb.stored("arrived_transactions", wb.transactions), wb)


@query("fact_loan_build")
def _(wb):
    return natural(wb.loans(), wb, "dim_customer", "dim_branch").select(
        "loan_id", "customer_id", "branch_id", "start_date_key", "loan_amount", "interest_rate", "start_date"
    )


def first_load(wb: Workbench) -> DataFrame:
    """The transactions up to 1997 as an earlier load."""
    early = wb["stg_transactions"].filter(F.col("transaction_date") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return wb.stored("first_load", lambda: load_keys(wb.transactions(early), "transaction_key"))


@query("fact_insert_if_absent")
def _(wb):
    """Two loads after the first, each of ids that came before and new ones, against ids stored by bucket."""
    stored, id_col, buckets = first_load(wb), "transaction_id", 8
    arrived = wb.stored("arrived_transactions", wb.transactions)

    def placed(load: int, rows: DataFrame) -> None:
        def write(folder: str) -> None:
            in_buckets(rows, id_col, buckets).hint("rebalance", "id_bucket").write.mode("overwrite").partitionBy("id_bucket").parquet(folder)

        wb.once(f"ids_by_load/load={load}", write)

    def ids() -> DataFrame:
        """The ids of all loads so far as one scan, as :class:`Layers` opens the folders of a table."""
        return wb.spark.read.schema(in_buckets(stored, id_col, buckets).schema).parquet(f"{wb.root}/ids_by_load").select(id_col, "id_bucket")

    placed(1, stored)
    few = arrived.filter("transaction_id like '%-1' or date_key < 19980301")
    second = wb.stored("second_load", lambda: facts.insert_if_absent(few, ids(), id_col, buckets))
    placed(2, second)
    # written like the load before, as turning keys back into ids reads the rows more than once
    third = wb.stored("third_load", lambda: facts.insert_if_absent(arrived, ids(), id_col, buckets))
    rows = stored.select(*facts.TRANSACTION_COLUMNS).unionByName(second).unionByName(third)
    return transaction_rows(rows, wb)


# --- marts -------------------------------------------------------------------


@query("mart_c360_accounts")
def _(wb):
    return marts.customer_accounts(wb["stg_accounts"], wb["dim_account"])


@query("mart_c360_spending")
def _(wb):
    rows = marts.customer_spending(wb["fact_transactions"], wb["dim_customer"])
    return natural(rows, wb, "dim_customer").drop("customer_key")


@query("mart_c360_loans")
def _(wb):
    rows = marts.customer_loans(wb["fact_loans"], wb["dim_customer"])
    return natural(rows, wb, "dim_customer").drop("customer_key")


@query("mart_credit_tier")
def _(wb):
    score = F.col("credit_score")
    return wb["dim_customer"].select(
        "customer_id", "credit_score", marts.credit_tier(score).alias("credit_tier"), marts.risk_tier(score).alias("risk_tier")
    )


@query("mart_customer_segment")
def _(wb):
    return wb["customer_360"].groupBy("customer_segment").agg(
        F.count("*").alias("customers"),
        F.min("total_balance_usd").alias("min_balance"),
        F.max("total_balance_usd").alias("max_balance"),
        F.max("total_spend_usd").alias("max_spend"),
    )


@query("mart_customer_360")
def _(wb):
    return wb.mart("customer_360").drop("customer_key")


@query("mart_daily_branch")
def _(wb):
    return wb.mart("daily_branch_performance").drop("branch_key")


@query("mart_daily_branch_default")
def _(wb):
    mart = marts.daily_branch_performance(wb["dim_date"], wb["dim_branch"], wb["fact_transactions"])
    return mart.drop("branch_key")


@query("mart_daily_branch_by_branch")
def _(wb):
    """Transactions handed to branches by their day of month; the 25th to none that exists."""
    number = F.dayofmonth("transaction_date") % 26
    branch_id = F.concat(F.lit("B"), F.lpad(number.cast("string"), 3, "0"))
    fact = lookup(
        wb["fact_transactions"].drop("branch_key").withColumn("branch_id", branch_id),
        wb["dim_branch"].select("branch_id", "branch_key"),
        "branch_id",
        "transaction_id",
    )
    unknown = facts.unknown_key(wb.dims(), "dim_branch")
    fact = fact.withColumn("branch_key", F.coalesce("branch_key", unknown))
    return marts.daily_branch_by_branch(wb["dim_date"], wb["dim_branch"], fact).drop("branch_key")


@query("mart_merchant")
def _(wb):
    return wb.mart("merchant_analytics").drop("merchant_key")


@query("mart_credit_risk")
def _(wb):
    return wb.mart("credit_risk_monitoring")


# --- scalar functions --------------------------------------------------------


@query("fn_initcap")
def _(wb):
    words = F.concat_ws("-", "c_mktsegment", "c_name")
    return wb.source("customer").select("c_custkey", capitalise_words(words).alias("capitalised"))


# --- data quality ------------------------------------------------------------


def _checked(check: Callable[[dict], DataFrame]) -> Query:
    return lambda wb: check(wb.warehouse() | wb.marts())


for _name, _check in {
    "dq_min_rows_warehouse": quality.min_rows_warehouse,
    "dq_min_rows_marts": quality.min_rows_marts,
    "dq_pk_not_null": quality.pk_not_null,
    "dq_pk_unique": quality.pk_unique,
    "dq_fk_transactions": quality.fk_transactions,
    "dq_fk_loans": quality.fk_loans,
    "dq_amount_positive": quality.amount_positive,
    "dq_loan_range": quality.loan_range,
    "dq_fico_range": quality.fico_range,
    "dq_recon_c360": quality.recon_c360,
    "dq_recon_merchant": quality.recon_merchant,
    "dq_recon_credit_risk": quality.recon_credit_risk,
    "dq_suite": quality.run_checks,
    "dq_natural_key_unique": quality.natural_key_unique,
}.items():
    REGISTRY[_name] = _checked(_check)


@query("dq_suite_summary")
def _(wb):
    return quality.suite_summary(quality.suite_report(quality.run_checks(wb.warehouse() | wb.marts())))


@query("dq_recon_contents")
def _(wb):
    """Errors that cancel in every total: a count moved from one key to another, a row kept twice and one lost."""
    marts = wb.marts()

    def moved(mart: str, key: str, column: str) -> DataFrame:
        rows = marts[mart]
        first, last = rows.agg(F.min(key)).scalar(), rows.agg(F.max(key)).scalar()
        by = F.when(F.col(key) == first, 1).when(F.col(key) == last, -1).otherwise(0)
        return rows.withColumn(column, (F.col(column) + by).cast(rows.schema[column].dataType))

    customers = marts["customer_360"]
    first, last = customers.agg(F.min("customer_id")).scalar(), customers.agg(F.max("customer_id")).scalar()
    stored = marts | {
        "customer_360": customers.where(F.col("customer_id") != last).unionByName(customers.where(F.col("customer_id") == first)),
        "merchant_analytics": moved("merchant_analytics", "merchant_id", "total_transactions"),
        "credit_risk_monitoring": moved("credit_risk_monitoring", "credit_risk_tier", "total_loans_originated"),
    }
    return quality.recon_contents(stored, {name: wb.mart(name) for name in quality.MART_KEYS})


@query("dq_max_length")
def _(wb):
    return quality.max_length(wb.staging() | wb.dims())


# --- profiling ---------------------------------------------------------------


@query("prof_null_blank")
def _(wb):
    return profiling.null_audit(wb.plain_staging())


@query("prof_schema_sample")
def _(wb):
    rows = profiling.schema_sample(wb.spark, wb.plain_staging())
    parts = []
    for table, columns in STAGING.items():
        own = rows.filter(F.col("table_name") == table)
        shown = [
            F.array_join(F.transform("sample_rows", lambda row: F.get_json_object(row, f"$.{c}")), ",", "~")  # noqa: B023
            for c in (columns[0].name, columns[1].name)
        ]
        parts.append(
            own.select("table_name", "column_count", "column_names", shown[0].alias("sample_ids"), shown[1].alias("sample_next"))
        )
    return quality.union_all(parts)


@query("prof_key_distinct")
def _(wb):
    return profiling.key_distinct(wb.plain_staging())


@query("prof_max_parents")
def _(wb):
    return profiling.max_parents(wb.plain_staging())


@query("prof_children_stats")
def _(wb):
    return profiling.children_stats(wb.plain_staging())


@query("prof_column_presence")
def _(wb):
    return profiling.column_presence(wb.plain_staging(), names=tuple(STAGING))


# --- dashboard ---------------------------------------------------------------


def _over(mart: str, fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda wb: fn(wb[mart])


for _name, _mart, _fn in (
    ("dash_segment_count", "customer_360", dashboard.segment_count),
    ("dash_vip_fico", "customer_360", dashboard.vip_fico),
    ("dash_credit_tier_count", "customer_360", dashboard.credit_tier_count),
    ("dash_year_volume", "daily_branch_performance", dashboard.year_volume),
    ("dash_branch_kpis", "daily_branch_performance", dashboard.branch_kpis),
    ("dash_top_branches", "daily_branch_performance", dashboard.top_branches),
    ("dash_branch_ranking", "daily_branch_performance", dashboard.branch_ranking),
    ("dash_merchant_kpis", "merchant_analytics", dashboard.merchant_kpis),
    ("dash_top_merchants", "merchant_analytics", dashboard.top_merchants),
    ("dash_top_cities", "merchant_analytics", dashboard.top_cities),
    ("dash_merchant_detail", "merchant_analytics", dashboard.merchant_detail),
    ("dash_risk_kpis", "credit_risk_monitoring", dashboard.risk_kpis),
    ("dash_interest_by_tier", "credit_risk_monitoring", dashboard.interest_by_tier),
    ("dash_debt_by_tier", "credit_risk_monitoring", dashboard.debt_by_tier),
):
    REGISTRY[_name] = _over(_mart, _fn)


@query("dash_filter_segment")
def _(wb):
    rows = dashboard.filter_segment(wb["customer_360"], ["PLATINUM_VIP", "GOLD_AFFLUENT"])
    return rows.select("customer_id", "customer_segment", "total_balance_usd", "total_spend_usd")


@query("dash_filter_year")
def _(wb):
    rows = dashboard.filter_year(wb["daily_branch_performance"], 1997)
    return rows.select("full_date", "branch_id", "daily_transactions_count", "daily_transaction_volume_usd")


@query("dash_exec_kpis")
def _(wb):
    return dashboard.exec_kpis(wb["customer_360"], wb["credit_risk_monitoring"])


@query("dash_weekend_by_month")
def _(wb):
    return dashboard.weekend_by_month(wb["daily_branch_performance"])


@query("dash_spend_debt_sample")
def _(wb):
    return dashboard.spend_debt_sample(wb["customer_360"])


@query("dash_customer_search")
def _(wb):
    return dashboard.customer_search(wb["customer_360"], "o'brien")


# --- incremental batch -------------------------------------------------------


def demo_batch(wb: Workbench) -> DataFrame:
    dims = {d: wb[d] for d in DIMENSIONS}
    return wb.stored("demo_batch", lambda: incremental.generate_batch(wb.spark, dims))


def with_demo(wb: Workbench) -> DataFrame:
    """The fact after the demonstration batch was appended."""
    stored = wb["fact_transactions"].select(*facts.TRANSACTION_COLUMNS)
    added = facts.insert_if_absent(demo_batch(wb), stored, "transaction_id")
    return stored.unionByName(added)


def stage(wb: Workbench, layers: Layers, settings: pipeline.Settings) -> None:
    """Publish the staging tables, each written once: in its layer."""
    for table in wb.staging():
        layers.write(pipeline.STG, table, wb.read_once(table), settings.run_id)
    layers.publish(pipeline.STG, settings.run_id, list(wb.staging()))


def demo_layers(wb: Workbench) -> tuple[Layers, DataFrame]:
    layers = Layers(wb.spark, f"{wb.root}/demo")
    first = wb.settings(run_ts=RUN_TS.replace(hour=1))

    def run(folder: str) -> None:
        stage(wb, layers, first)
        pipeline.build_warehouse(layers, first)
        pipeline.build_marts(layers, first)
        compared = pipeline.add_demo_batch(layers, wb.settings(run_ts=RUN_TS.replace(hour=2)))
        compared.write.mode("overwrite").parquet(f"{folder}/compared")
        pipeline.reset_demo(layers, wb.settings(run_ts=RUN_TS.replace(hour=3)))

    folder = wb.once("demo_done", run)
    return layers, wb.spark.read.parquet(f"{folder}/compared")


@query("inc_generate")
def _(wb):
    return transaction_rows(demo_batch(wb), wb)


@query("inc_append")
def _(wb):
    return transaction_rows(with_demo(wb), wb)


@query("inc_metrics")
def _(wb):
    return incremental.metrics(with_demo(wb), wb["customer_360"], wb["daily_branch_performance"])


@query("inc_compare")
def _(wb):
    return demo_layers(wb)[1]


@query("inc_reset")
def _(wb):
    layers, _ = demo_layers(wb)
    return audit.row_counts(
        {t: layers.read(pipeline.DWH, t) for t in ("fact_transactions", "dim_date")} | layers.tables(pipeline.MART)
    )


def merged_layers(wb: Workbench) -> Layers:
    """An early load, one of all rows, the demonstration batch and its reset: marts from sums stored load by load."""
    layers = Layers(wb.spark, f"{wb.root}/merged")

    def run(_: str) -> None:
        first, second, third, fourth = (wb.settings(run_ts=RUN_TS.replace(hour=h), compact_folders=2) for h in (1, 2, 3, 4))
        stage(wb, layers, first)
        stg = layers.tables(pipeline.STG)
        early = stg["stg_transactions"].filter(F.col("transaction_date") < F.lit("1996-07-01").cast("timestamp_ntz"))
        pipeline.build_warehouse(layers, first, stg | {"stg_transactions": early})
        pipeline.build_warehouse(layers, replace(second, mode="upsert"))
        pipeline.build_marts(layers, second)
        pipeline.add_demo_batch(layers, third)
        pipeline.reset_demo(layers, fourth)

    wb.once("merged_done", run)
    return layers


@query("inc_marts_customers")
def _(wb):
    return merged_layers(wb).read(pipeline.MART, "customer_360").drop("mart_updated_at", "customer_key")


@query("inc_marts_merchants")
def _(wb):
    return merged_layers(wb).read(pipeline.MART, "merchant_analytics").drop("mart_updated_at", "merchant_key")


@query("inc_compact")
def _(wb):
    """The transactions after their small folders were merged."""
    stored = merged_layers(wb).tables(pipeline.DWH)
    return transaction_rows(stored["fact_transactions"].select(*facts.TRANSACTION_COLUMNS), stored)


@query("inc_refresh_marts")
def _(wb):
    with_days = dimensions.ensure_dates(wb["dim_date"], incremental.demo_dates(wb.spark))
    dwh = wb.warehouse() | {"dim_date": with_days, "fact_transactions": with_demo(wb)}
    frames = pipeline.mart_frames(wb.staging(), dwh, wb.settings().branch_limit)
    parts = [
        ("customer_360", "total_transactions", "total_spend_usd"),
        ("daily_branch_performance", "daily_transactions_count", "daily_transaction_volume_usd"),
        ("merchant_analytics", "total_transactions", "total_sales_volume_usd"),
        ("credit_risk_monitoring", "total_loans_originated", "total_loan_debt_usd"),
    ]
    return quality.union_all(
        [
            frames[m].agg(F.count("*").alias("rows"), F.sum(n).alias("items"), F.sum(v).alias("amount")).select(
                F.lit(m).alias("mart"), "rows", "items", "amount"
            )
            for m, n, v in parts
        ]
    )


# --- run audit ---------------------------------------------------------------


def pipeline_run(wb: Workbench) -> tuple[Layers, DataFrame]:
    """The whole pipeline over the landed files."""
    layers = Layers(wb.spark, f"{wb.root}/run")
    wb.once("run_done", lambda _: pipeline.run_pipeline(wb.spark, raw_base(wb), layers.root, settings=wb.settings()))
    return layers, layers.read(pipeline.AUDIT, "alerts")


@query("snk_rowcount_observed")
def _(wb):
    """The rows of all layers as counted while they were written."""
    stored = Layers(wb.spark, pipeline_run(wb)[0].root)  # as another process reads the notes
    counts = [stored.row_counts(pipeline.STG), stored.row_counts(pipeline.DWH, list(PRIMARY_KEYS)), stored.row_counts(pipeline.MART)]
    return quality.union_all(counts)


@query("audit_run_table")
def _(wb):
    layers, _ = pipeline_run(wb)
    return pipeline.all_runs(layers).select("stage", "status", F.coalesce("rows", F.lit(0)).alias("rows"))


@query("audit_alert_rows")
def _(wb):
    _, alerts = pipeline_run(wb)
    return alerts.select("alert_type", "priority", "stage", "subject", "message")


@query("audit_log_classify")
def _(wb):
    kind = F.col("event_type")
    line = (
        F.when(kind == "view", F.concat(F.lit("REPORT RequestId: "), F.col("event_id").cast("string")))
        .when(kind == "error", F.concat(F.lit("[ERROR] user "), F.col("user_id").cast("string"), F.lit("  ")))
        .when(kind == "signup", F.concat(F.lit("START RequestId: "), F.col("event_id").cast("string")))
        .when(kind == "click", F.concat(F.lit("TimeoutException after "), F.col("value").cast("string")))
        .otherwise(F.concat(F.lit("loaded "), F.col("props")))
    )
    folder = wb.once(
        "log_lines", lambda f: wb.source("events").select(line.alias("value")).write.mode("overwrite").text(f)
    )
    return audit.classify_log(wb.spark.read.text(folder))


# --- streaming ---------------------------------------------------------------


@query("stream_fact_load")
def _(wb):
    """Transactions that land on one day and, a third of them, again on the next."""
    # opened before the stream starts: its thread must not wait for a table, as this one holds the workbench meanwhile
    by_account, dims = wb["account_keys"], dict(wb.dims())
    rows = wb.stored("first_copies", lambda: facts.first_transactions(facts.valid_transactions(wb.read_once("stg_transactions"))))

    def land(folder: str) -> None:
        raw.land(rows, folder, "transactions", RUN_DATE)
        raw.land(rows.filter("transaction_id like '%-1'"), folder, "transactions", RUN_DATE + timedelta(1))

    base = wb.once("raw_stream", land)

    def run(folder: str) -> None:
        tables = facts.held_tables(by_account, dims, BATCH_BROADCAST_BYTES)

        def build(batch: DataFrame) -> DataFrame:
            return facts.build_transactions(batch, by_account, dims, broadcast_bytes=BATCH_BROADCAST_BYTES, tables=tables)

        try:
            stream = transaction_stream(wb.spark, base, max_files=4)
            load_available(stream, build, f"{folder}/fact", f"{folder}/checkpoint").awaitTermination()
        finally:
            tables.release()

    folder = wb.once("stream", run)
    return transaction_rows(wb.spark.read.parquet(f"{folder}/fact"), wb)
