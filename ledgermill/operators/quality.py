"""Data-quality checks. Each returns rows (check_name, table_name, column_name, bad_count, passed, detail)."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.schemas import (
    DIMENSIONS,
    FACT_NATURAL_KEYS,
    FOREIGN_KEYS,
    MIN_ROWS_MARTS,
    MIN_ROWS_WAREHOUSE,
    PRIMARY_KEYS,
    STAGING,
    UNKNOWN_ID,
)

Tables = Mapping[str, DataFrame]

# Accepted ranges.
MAX_INTEREST_RATE = 40
SCORE_RANGE = (300, 850)

# The seven parts of the suite and the checks in each.
SUITE = (
    ("Table Completeness & Volume", ("min_rows_warehouse",)),
    ("Data Marts Completeness", ("min_rows_marts",)),
    ("Primary Keys Uniqueness & Not-Null", ("pk_not_null", "pk_unique")),
    ("Fact Transactions Referential Integrity", ("fk_transactions",)),
    ("Fact Loans Referential Integrity", ("fk_loans",)),
    ("Financial Business Range Validation", ("amount_positive", "loan_range", "fico_range")),
    ("Data Mart Reconciliation", ("recon_c360", "recon_merchant", "recon_credit_risk")),
)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union in pairs, which keeps the plans that are analysed on the way small."""
    while len(frames) > 1:
        pairs = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])]
        frames = pairs + frames[len(pairs) * 2 :]
    return frames[0]


@dataclass(frozen=True)
class ScanCheck:
    """A check that one aggregate over its table answers."""

    check: str
    table: str
    column: str
    bad: Column
    detail: Column


def scan(tables: Tables, checks: list[ScanCheck]) -> DataFrame:
    """Run checks with one pass per table, however many checks it has."""
    by_table: dict[str, list[ScanCheck]] = {}
    for c in checks:
        by_table.setdefault(c.table, []).append(c)

    def entry(c: ScanCheck) -> Column:
        return F.struct(
            F.lit(c.check).alias("check_name"),
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            c.bad.cast("bigint").alias("bad_count"),
            c.detail.cast("string").alias("detail"),
        )

    rows = union_all(
        [tables[t].agg(F.array(*[entry(c) for c in group]).alias("x")) for t, group in by_table.items()]
    )
    return rows.select(F.inline("x")).select(
        "check_name", "table_name", "column_name", "bad_count", (F.col("bad_count") == 0).alias("passed"), "detail"
    )


def _min_rows(check: str, thresholds: dict[str, int]) -> list[ScanCheck]:
    n = F.count("*")
    return [
        ScanCheck(
            check,
            table,
            "*",
            F.greatest(F.lit(least).cast("bigint") - n, F.lit(0).cast("bigint")),
            F.concat_ws("/", n.cast("string"), F.lit(str(least))),
        )
        for table, least in thresholds.items()
    ]


def _pk_not_null(keys: dict[str, str]) -> list[ScanCheck]:
    return [
        ScanCheck("pk_not_null", table, key, F.count_if(F.col(key).isNull()), F.lit("")) for table, key in keys.items()
    ]


def _amount_positive() -> list[ScanCheck]:
    bad = F.count_if(F.col("amount_usd") <= 0)
    return [ScanCheck("amount_positive", "fact_transactions", "amount_usd", bad, F.lit("amount <= 0"))]


def _loan_range(max_rate: int) -> list[ScanCheck]:
    rate = F.col("interest_rate")
    bad = F.count_if((F.col("loan_amount") <= 0) | (rate < 0) | (rate > max_rate))
    detail = F.lit(f"amount <= 0 or rate outside 0..{max_rate}")
    return [ScanCheck("loan_range", "fact_loans", "loan_amount,interest_rate", bad, detail)]


def _fico_range() -> list[ScanCheck]:
    low, high = SCORE_RANGE
    score = F.col("credit_score")
    bad = F.count_if((F.col("customer_id") != UNKNOWN_ID) & ((score < low) | (score > high)))
    return [ScanCheck("fico_range", "dim_customer", "credit_score", bad, F.lit(f"outside {low}..{high}"))]


def min_rows_warehouse(tables: Tables, thresholds: dict[str, int] = MIN_ROWS_WAREHOUSE) -> DataFrame:
    """bad_count is the number of rows short of the threshold."""
    return scan(tables, _min_rows("min_rows_warehouse", thresholds))


def min_rows_marts(tables: Tables, thresholds: dict[str, int] = MIN_ROWS_MARTS) -> DataFrame:
    return scan(tables, _min_rows("min_rows_marts", thresholds))


def pk_not_null(tables: Tables, keys: dict[str, str] = PRIMARY_KEYS) -> DataFrame:
    return scan(tables, _pk_not_null(keys))


def amount_positive(tables: Tables) -> DataFrame:
    return scan(tables, _amount_positive())


def loan_range(tables: Tables, max_rate: int = MAX_INTEREST_RATE) -> DataFrame:
    return scan(tables, _loan_range(max_rate))


def fico_range(tables: Tables) -> DataFrame:
    """The stand-in score of a bad input counts as bad here too."""
    return scan(tables, _fico_range())


def _listed(check: str, found: DataFrame, targets: list[tuple[str, str]], detail: Column) -> DataFrame:
    """A result row for each (table, column), with what was ``found`` for its position ``i``.

    ``found`` has at most one row per position.
    """
    spark = found.sparkSession
    entries = [
        F.struct(F.lit(i).alias("i"), F.lit(t).alias("t"), F.lit(c).alias("c")) for i, (t, c) in enumerate(targets)
    ]
    wanted = spark.range(1, numPartitions=1).select(F.explode(F.array(*entries)).alias("x")).select("x.*")
    rows = wanted.join(F.broadcast(found), "i", "left")
    bad = F.coalesce("n", F.lit(0))
    return rows.select(
        F.lit(check).alias("check_name"),
        F.col("t").alias("table_name"),
        F.col("c").alias("column_name"),
        bad.cast("bigint").alias("bad_count"),
        (bad == 0).alias("passed"),
        detail.alias("detail"),
    )


def _unique(check: str, tables: Tables, keys: dict[str, str], kind: str) -> DataFrame:
    """Repeated key values of all tables in one grouping, with the five smallest as detail.

    Ranking keeps five values per table and task, so no task sees them all.
    """
    targets = list(keys.items())
    values = union_all(
        [tables[t].select(F.lit(i).alias("i"), F.col(key).cast(kind).alias("k")) for i, (t, key) in enumerate(targets)]
    )
    repeated = values.groupBy("i", "k").count().filter("count > 1").select("i", "k")
    rank = F.row_number().over(Window.partitionBy("i").orderBy("k"))
    smallest = repeated.withColumn("r", rank).filter("r <= 5").groupBy("i").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("k")), lambda k: k.cast("string")), ", ").alias("examples")
    )
    found = repeated.groupBy("i").agg(F.count("*").alias("n")).join(smallest, "i", "left")
    return _listed(check, found, targets, F.coalesce("examples", F.lit("")))


def pk_unique(tables: Tables, keys: dict[str, str] = PRIMARY_KEYS) -> DataFrame:
    return _unique("pk_unique", tables, keys, "bigint")


def natural_key_unique(tables: Tables) -> DataFrame:
    """Natural keys of dimensions and facts occur once."""
    keys = {name: spec.natural_key for name, spec in DIMENSIONS.items()} | FACT_NATURAL_KEYS
    return _unique("natural_key_unique", tables, {t: k for t, k in keys.items() if t in tables}, "string")


def _foreign_keys(check: str, fact: str, tables: Tables) -> DataFrame:
    """Fact rows whose key finds no dimension row, for all keys in one pass; a null key is an orphan.

    The fact shrinks to one row per key value before anything is joined, so the
    anti join is as small as the dimensions however skewed the keys are.
    """
    links = FOREIGN_KEYS[fact]
    entries = [
        F.struct(F.lit(i).alias("i"), F.col(key).cast("bigint").alias("k")) for i, (key, _, _) in enumerate(links)
    ]
    used = tables[fact].select(F.explode(F.array(*entries)).alias("x")).groupBy("x.i", "x.k").count()
    known = union_all(
        [tables[d].select(F.lit(i).alias("i"), F.col(pk).cast("bigint").alias("k")) for i, (_, d, pk) in enumerate(links)]
    )
    lost = used.join(known, ["i", "k"], "left_anti").groupBy("i").agg(F.sum("count").alias("n"))
    dims = F.array(*[F.lit(f"not in {d}") for _, d, _ in links])
    targets = [(fact, key) for key, _, _ in links]
    return _listed(check, lost, targets, F.get(dims, F.col("i")))


def fk_transactions(tables: Tables) -> DataFrame:
    return _foreign_keys("fk_transactions", "fact_transactions", tables)


def fk_loans(tables: Tables) -> DataFrame:
    return _foreign_keys("fk_loans", "fact_loans", tables)


def _reconcile(check: str, mart: str, column: str, expected: DataFrame, actual: DataFrame) -> DataFrame:
    one = expected.sparkSession.range(1, numPartitions=1)
    both = one.select(expected.scalar().alias("e"), actual.scalar().alias("a"))
    gap = F.abs(F.coalesce(F.col("e"), F.lit(0)) - F.coalesce(F.col("a"), F.lit(0))).cast("bigint")
    return both.select(
        F.lit(check).alias("check_name"),
        F.lit(mart).alias("table_name"),
        F.lit(column).alias("column_name"),
        gap.alias("bad_count"),
        (gap == 0).alias("passed"),
        F.concat_ws("/", F.col("a").cast("string"), F.col("e").cast("string")).alias("detail"),
    )


def recon_c360(tables: Tables) -> DataFrame:
    real = tables["dim_customer"].filter(F.col("customer_id") != UNKNOWN_ID).agg(F.count("*"))
    return _reconcile("recon_c360", "customer_360", "*", real, tables["customer_360"].agg(F.count("*")))


def recon_merchant(tables: Tables) -> DataFrame:
    facts = tables["fact_transactions"].agg(F.count("*"))
    mart = tables["merchant_analytics"].agg(F.sum("total_transactions"))
    return _reconcile("recon_merchant", "merchant_analytics", "total_transactions", facts, mart)


def recon_credit_risk(tables: Tables) -> DataFrame:
    facts = tables["fact_loans"].agg(F.count("*"))
    mart = tables["credit_risk_monitoring"].agg(F.sum("total_loans_originated"))
    return _reconcile("recon_credit_risk", "credit_risk_monitoring", "total_loans_originated", facts, mart)


MART_KEYS = {
    "customer_360": "customer_id",
    "merchant_analytics": "merchant_id",
    "credit_risk_monitoring": "credit_risk_tier",
}
STAMPS = ("mart_updated_at",)


def _differing(name: str, key: str, stored: DataFrame, expected: DataFrame) -> DataFrame:
    """Keys of a mart whose rows differ from those expected, and in which columns.

    Rows of both sides meet in one grouping by key. Each column is compared by
    the sum of its values' hashes, stored ones added and expected ones taken
    away, so order doesn't count and repeated rows do; partial sums are made
    before the shuffle, and no value is moved.
    """
    columns = [c for c in stored.columns if c in expected.columns and c != key and c not in STAMPS]

    def side(rows: DataFrame, sign: int) -> DataFrame:
        digest = lambda c: F.xxhash64(F.col(c).cast(stored.schema[c].dataType)).cast("decimal(20,0)") * F.lit(sign)
        return rows.select(F.col(key).cast("string").alias("key_value"), F.lit(sign).alias("sign"), *(digest(c).alias(c) for c in columns))

    compared = (
        side(stored, 1)
        .unionByName(side(expected, -1))
        .groupBy("key_value")
        .agg(
            F.count_if(F.col("sign") > 0).alias("stored_rows"),
            F.count_if(F.col("sign") < 0).alias("expected_rows"),
            *(F.sum(c).alias(c) for c in columns),
        )
    )
    uneven = F.col("stored_rows") != F.col("expected_rows")
    wrong = F.filter(F.array(*(F.when(F.col(c) != 0, F.lit(c)) for c in columns)), F.isnotnull)
    return compared.select(
        F.lit(name).alias("table_name"),
        "key_value",
        F.explode(F.when(uneven, F.array(F.lit("*"))).otherwise(wrong)).alias("column_name"),
        "stored_rows",
        "expected_rows",
    )


def recon_contents(stored: Tables, expected: Tables) -> DataFrame:
    """What the marts hold against what their facts give, key by key.

    ``table_name, key_value, column_name, stored_rows, expected_rows``: a row for
    each column of a key that differs, or one with column ``*`` if the key has
    more or fewer rows than it should. Totals may agree where errors cancel;
    this finds both. Timestamps of the run don't count.
    """
    return union_all(
        [_differing(name, key, stored[name], expected[name]) for name, key in MART_KEYS.items() if name in stored and name in expected]
    )


def max_length(tables: Tables) -> DataFrame:
    """Texts longer than declared: staging tables by name, dimensions by theirs. One pass per table."""
    widths: dict[str, list[tuple[str, int]]] = {}
    for name, columns in STAGING.items():
        widths[f"stg_{name}"] = [(c.name, c.max_length) for c in columns if c.max_length]
    for name, spec in DIMENSIONS.items():
        widths[name] = list(spec.widths)

    checks = [
        ScanCheck("max_length", name, c, F.count_if(F.length(c) > n), F.lit(f"longer than {n}"))
        for name, limits in widths.items()
        if name in tables
        for c, n in limits
    ]
    return scan(tables, checks)


def run_checks(tables: Tables, thresholds: dict[str, int] | None = None) -> DataFrame:
    """All checks of the suite; those that only need a pass over a table share it.

    ``thresholds`` replaces the full-size minimum row counts.
    """
    limits = thresholds or (MIN_ROWS_WAREHOUSE | MIN_ROWS_MARTS)
    scanned = [
        *_min_rows("min_rows_warehouse", {t: limits[t] for t in MIN_ROWS_WAREHOUSE}),
        *_min_rows("min_rows_marts", {t: limits[t] for t in MIN_ROWS_MARTS}),
        *_pk_not_null(PRIMARY_KEYS),
        *_amount_positive(),
        *_loan_range(MAX_INTEREST_RATE),
        *_fico_range(),
    ]
    return union_all(
        [
            scan(tables, scanned),
            pk_unique(tables),
            fk_transactions(tables),
            fk_loans(tables),
            recon_c360(tables),
            recon_merchant(tables),
            recon_credit_risk(tables),
        ]
    )


def run_parts(tables: Tables, store: Callable[[str, DataFrame], DataFrame], thresholds: dict[str, int] | None = None) -> DataFrame:
    """The suite part by part: results of all parts, and a row of ``bad_count`` null for one that could not run.

    ``store`` writes a part's results down under a name and returns them as
    stored, so a part that throws is caught alone.
    """
    limits = thresholds or (MIN_ROWS_WAREHOUSE | MIN_ROWS_MARTS)
    work: dict[str, Callable[[], list[DataFrame]]] = {
        "min_rows_warehouse": lambda: [min_rows_warehouse(tables, {t: limits[t] for t in MIN_ROWS_WAREHOUSE})],
        "min_rows_marts": lambda: [min_rows_marts(tables, {t: limits[t] for t in MIN_ROWS_MARTS})],
        "pk_not_null": lambda: [pk_not_null(tables), pk_unique(tables)],
        "fk_transactions": lambda: [fk_transactions(tables)],
        "fk_loans": lambda: [fk_loans(tables)],
        "amount_positive": lambda: [amount_positive(tables), loan_range(tables), fico_range(tables)],
        "recon_c360": lambda: [recon_c360(tables), recon_merchant(tables), recon_credit_risk(tables)],
    }
    spark = next(iter(tables.values())).sparkSession
    results = []
    for first, checks in work.items():
        try:
            results.append(store(f"quality_{first}", union_all(checks())))
        except Exception as failure:  # noqa: BLE001 - whatever a check throws is its part's result
            reason = f"{type(failure).__name__}: {failure}"
            results.append(
                spark.range(1, numPartitions=1).select(
                    F.lit(first).alias("check_name"),
                    F.lit("*").alias("table_name"),
                    F.lit("*").alias("column_name"),
                    F.lit(None).cast("bigint").alias("bad_count"),
                    F.lit(None).cast("boolean").alias("passed"),
                    F.lit(reason).alias("detail"),
                )
            )
    return union_all(results)


def suite_report(results: DataFrame) -> DataFrame:
    """One row per part of the suite: status, failed checks and the first reason.

    A part is ERROR if a check of it could not run (``passed`` is null), else
    FAILED if one did not pass.
    """
    part = F.create_map(*[F.lit(x) for name, checks in SUITE for c in checks for x in (c, name)])
    failed, threw = ~F.col("passed"), F.col("passed").isNull()
    reason = F.concat_ws(" ", "check_name", F.concat_ws(".", "table_name", "column_name"), F.col("bad_count").cast("string"))
    error = F.concat_ws(" ", "check_name", "detail")
    return (
        results.withColumn("part", part[F.col("check_name")])
        .groupBy("part")
        .agg(
            F.count("*").alias("checks"),
            F.count_if(failed).alias("failed_checks"),
            F.coalesce(F.min(F.when(threw, error)), F.min(F.when(failed, reason))).alias("reason"),
            F.count_if(threw).alias("_threw"),
        )
        .withColumn(
            "status",
            F.when(F.col("_threw") > 0, "ERROR").when(F.col("failed_checks") == 0, "PASSED").otherwise("FAILED"),
        )
        .drop("_threw")
    )


def suite_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count("*").alias("total_tests"),
        F.count_if(F.col("status") == "PASSED").alias("passed_tests"),
        F.count_if(F.col("status") != "PASSED").alias("failed_tests"),
    )
