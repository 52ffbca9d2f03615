"""Null audit and relationship profiling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators.quality import union_all
from ledgermill.schemas import STAGING

# Columns of the null audit (all but the customer's creation date).
AUDITED = {
    table: tuple(c.name for c in columns if c.name != "created_at") for table, columns in STAGING.items()
}

# Table -> its id, and (child table, child id, parent id) links.
IDS = {
    "customers": "customer_id",
    "accounts": "account_id",
    "cards": "card_id",
    "loans": "loan_id",
    "merchants": "merchant_id",
    "branches": "branch_id",
}
LINKS = (
    ("accounts", "account_id", "customer_id"),
    ("cards", "card_id", "account_id"),
    ("loans", "loan_id", "customer_id"),
)
BRANCH_CHECKED = ("customers", "accounts", "cards", "loans")


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(part * F.lit(100.0) / whole, 2)).otherwise(F.lit(0.0))


def null_or_blank(rows: DataFrame, table: str, columns: tuple[str, ...]) -> DataFrame:
    """Missing or blank values per column, in one pass over the table."""

    def blank(c: str) -> Column:
        return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")

    counted = rows.agg(F.count("*").alias("_rows"), *[F.count_if(blank(c)).alias(c) for c in columns])
    entries = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns]
    return counted.select(
        F.lit(table).alias("table_name"), "_rows", F.explode(F.array(*entries)).alias("x")
    ).select(
        "table_name",
        "x.column_name",
        F.col("_rows").alias("total_rows"),
        "x.null_count",
        _percent(F.col("x.null_count"), F.col("_rows")).alias("null_percent"),
    )


def null_audit(staging: dict[str, DataFrame]) -> DataFrame:
    return union_all([null_or_blank(staging[t], t, columns) for t, columns in AUDITED.items()])


def schema_sample(spark: SparkSession, tables: dict[str, DataFrame], rows: int = 2) -> DataFrame:
    """Column count, column names and the first rows (as JSON, ordered by the first column)."""

    def one(name: str, table: DataFrame) -> DataFrame:
        columns = table.columns
        whole_row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        first = table.orderBy(*columns).limit(rows).agg(F.array_sort(F.collect_list(whole_row)).alias("sample_rows"))
        return first.select(
            F.lit(name).alias("table_name"),
            F.lit(len(columns)).alias("column_count"),
            F.lit(", ".join(columns)).alias("column_names"),
            "sample_rows",
        )

    return union_all([one(name, table) for name, table in tables.items()])


def key_distinct(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows against distinct ids. Ids are grouped first, so copies collapse inside each task."""

    def one(table: str, key: str) -> DataFrame:
        per_id = tables[table].groupBy(key).count()
        return per_id.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), F.count(key).alias("distinct_ids")).select(
            F.lit(table).alias("table_name"), F.lit(key).alias("key_name"), "rows", "distinct_ids"
        )

    return union_all([one(t, k) for t, k in IDS.items()])


def max_parents(tables: dict[str, DataFrame]) -> DataFrame:
    """Most distinct parents any child has; 1 means many-to-one."""

    def one(table: str, child: str, parent: str) -> DataFrame:
        pairs = tables[table].filter(F.col(child).isNotNull()).select(child, parent).distinct()
        per_child = pairs.groupBy(child).agg(F.count(parent).alias("n"))
        return per_child.agg(F.max("n").alias("max_parents")).select(
            F.lit(child).alias("child"), F.lit(parent).alias("parent"), "max_parents"
        )

    return union_all([one(*link) for link in LINKS])


def children_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Fewest, most and mean children per parent, over parents named by a child row."""

    def one(table: str, child: str, parent: str) -> DataFrame:
        per_parent = tables[table].filter(F.col(parent).isNotNull()).groupBy(parent).agg(F.count(child).alias("n"))
        return per_parent.agg(
            F.min("n").alias("min_children"),
            F.max("n").alias("max_children"),
            F.round(F.avg("n"), 2).alias("mean_children"),
        ).select(F.lit(parent).alias("parent"), F.lit(child).alias("child"), "min_children", "max_children", "mean_children")

    return union_all([one(*link) for link in LINKS])


def column_presence(
    tables: dict[str, DataFrame], column: str = "branch_id", names: tuple[str, ...] = BRANCH_CHECKED
) -> DataFrame:
    """Whether each table has the column, and how many of its rows fill it."""

    def one(name: str) -> DataFrame:
        table = tables[name]
        present = column in table.columns
        filled = F.count(column) if present else F.lit(0).cast("bigint")
        return table.agg(F.count("*").alias("rows"), F.max(F.lit(present)).alias("_any"), filled.alias("filled_rows")).select(
            F.lit(name).alias("table_name"),
            F.lit(column).alias("column_name"),
            F.lit(present).alias("present"),
            "rows",
            "filled_rows",
        )

    return union_all([one(name) for name in names])
