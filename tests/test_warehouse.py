from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermill import schemas
from ledgermill.operators import dimensions, facts, incremental, marts
from ledgermill.operators.keys import dense_keys, load_keys
from ledgermill.operators.lookups import absent_from, frequent_keys, held, lookup, spread_lookup

RUN = date(2024, 1, 1)


def frame(spark, table, rows):
    return spark.createDataFrame(rows, schemas.staging_schema(table))


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Writes a frame and returns it as read back, as the layers do."""

    def write(rows):
        path = str(tmp_path_factory.mktemp("t") / "rows")
        rows.coalesce(1).write.parquet(path)
        return spark.read.parquet(path)

    return write


@pytest.fixture(scope="module")
def stg(spark, stored):
    tables = {
        "customers": frame(
            spark,
            "customers",
            [
                ("C1", " ann ", "o'neil", " Ann@X.Example", "hà nội", 760, date(2020, 1, 1)),
                (" C2 ", "", None, "bad", " ", 299, None),
                ("  ", "no", "id", None, None, None, None),
                (None, "no", "id", None, None, None, None),
            ],
        ),
        "accounts": frame(
            spark,
            "accounts",
            [
                ("A1", "C1", "checking", Decimal("10.00"), date(2021, 1, 1)),
                ("A2", "C2", "other kind", None, None),
                ("A3", "C-GONE", "CREDIT", Decimal("5.00"), date(2021, 1, 1)),
            ],
        ),
        "cards": frame(
            spark,
            "cards",
            [
                ("K1", "A1", "debit", date(2030, 1, 1)),
                ("K2", "A1", "gold", None),
                ("K3", "A2", "credit", date(2026, 1, 1)),
                ("K4", "A2", "credit", date(2027, 1, 1)),
            ],
        ),
        "merchants": frame(spark, "merchants", [("M1", " ", "da-nang"), ("M2", "shop", None)]),
        "branches": frame(spark, "branches", [("B2", "", "le van"), ("B1", "Main", None)]),
        "loans": frame(
            spark,
            "loans",
            [
                ("L1", "C1", Decimal("100.00"), Decimal("5.00"), date(2024, 1, 2)),
                ("L2", "C-GONE", Decimal("50.00"), Decimal("0.00"), date(2024, 1, 2)),
                ("L3", "C1", Decimal("0.00"), Decimal("1.00"), date(2024, 1, 2)),
                ("L4", "C1", Decimal("1.00"), None, date(2024, 1, 2)),
            ],
        ),
        "transactions": frame(
            spark,
            "transactions",
            [
                ("T1", "A1", "M1", Decimal("10.00"), datetime(2024, 1, 2, 3)),
                ("T1", "A1", "M2", Decimal("99.00"), datetime(2024, 1, 3)),
                ("T2", "A2", "M9", Decimal("0.01"), datetime(2024, 1, 2)),
                ("T3", "A3", "M2", Decimal("0.02"), datetime(2024, 1, 6)),
                ("T4", "A9", "M1", Decimal("7.00"), datetime(2024, 1, 6)),
                ("T5", "A1", None, Decimal("7.00"), datetime(2024, 1, 6)),
                ("T6", "A1", "M1", Decimal("0.00"), datetime(2024, 1, 6)),
            ],
        ),
    }
    return {name: stored(rows) for name, rows in tables.items()}


@pytest.fixture(scope="module")
def dims(spark, stg, stored):
    out = {n: stored(dimensions.build_dimension(n, stg[s.source], RUN)) for n, s in schemas.DIMENSIONS.items()}
    out["dim_date"] = dimensions.build_dim_date(spark, date(2024, 1, 1), date(2024, 1, 31))
    return out


def ids(table, dim):
    spec = schemas.DIMENSIONS[dim]
    return {r[spec.surrogate_key]: r[spec.natural_key] for r in table.collect()}


@pytest.fixture(scope="module")
def by_account(stg, dims, stored):
    return stored(
        facts.account_keys(
            stg["accounts"], stg["cards"], dims["dim_customer"], dims["dim_account"], dims["dim_card"]
        )
    )


@pytest.fixture(scope="module")
def transactions(stg, dims, by_account, stored):
    return stored(facts.build_transactions(stg["transactions"], by_account, dims))


def test_rows_meet_accounts_without_the_merchant_id(stg, dims, by_account, monkeypatch):
    """The wider shuffle comes last and carries the merchant's key alone."""
    carried, joined = {}, facts.lookup

    def noted(rows, table, key, *more):
        carried[key] = rows.columns
        return joined(rows, table, key, *more)

    monkeypatch.setattr(facts, "lookup", noted)
    assert facts.build_transactions(stg["transactions"], by_account, dims, broadcast_bytes=0).count() > 0
    assert "merchant_key" in carried["account_id"] and "merchant_id" not in carried["account_id"]


def test_customer_rules(dims):
    rows = {r.customer_id: r for r in dims["dim_customer"].collect()}
    assert set(rows) == {"C1", "C2", "UNKNOWN"}
    assert (rows["C1"].full_name, rows["C1"].email, rows["C1"].city) == ("Ann O'Neil", "ann@x.example", "Hà Nội")
    c2 = rows["C2"]
    assert (c2.full_name, c2.email, c2.city, c2.credit_score, c2.created_at) == (
        "Unknown Customer",
        "invalid-email@bank.internal",
        "Unknown City",
        -1,
        RUN,
    )
    assert rows["UNKNOWN"].created_at == date(1900, 1, 1)


def test_other_dimension_rules(dims):
    accounts = {r.account_id: r for r in dims["dim_account"].collect()}
    assert accounts["A2"].account_type == "OTHER" and accounts["A2"].balance_usd == 0 and accounts["A2"].open_date == RUN
    assert {r.card_id: r.card_type for r in dims["dim_card"].collect()}["K2"] == "STANDARD"
    merchants = {r.merchant_id: r for r in dims["dim_merchant"].collect()}
    assert merchants["M1"].merchant_name == "Unknown Merchant" and merchants["M1"].city == "Da-Nang"
    branches = {r.branch_id: r for r in dims["dim_branch"].collect()}
    assert branches["B2"].branch_name == "General Branch" and branches["B2"].manager_name == "Le Van"


def test_repeated_natural_key_fails_or_keeps_the_first(spark):
    twice = frame(spark, "branches", [("B1", "b", None), ("B1 ", "a", None), ("B2", "c", None)])
    with pytest.raises(Exception, match="duplicate branch_id in one batch: B1"):
        dimensions.build_dimension("dim_branch", twice, RUN).collect()
    kept = dimensions.build_dimension("dim_branch", twice, RUN, on_duplicate="keep_first").collect()
    assert sorted((r.branch_id, r.branch_name) for r in kept) == [
        ("B1", "a"),
        ("B2", "c"),
        ("UNKNOWN", "General / Online Branch"),
    ]
    clean = dimensions.clean_branches(twice)
    assert [tuple(r) for r in dimensions.duplicate_ids(clean, "branch_id").collect()] == [("B1", 2)]


def test_upsert_keeps_keys_and_creation_date(spark, dims):
    old = dims["dim_customer"]
    batch = frame(
        spark,
        "customers",
        [
            ("C1", "new", "name", None, None, None, date(2024, 5, 5)),
            ("C3", "third", "x", None, None, 700, date(2024, 5, 5)),
        ],
    )
    new = dimensions.build_dimension("dim_customer", batch, RUN, old)
    before, after = ({r.customer_id: r for r in t.collect()} for t in (old, new))
    assert set(after) == {"C1", "C2", "C3", "UNKNOWN"}
    for known in before:
        assert after[known].customer_key == before[known].customer_key
    assert after["C1"].full_name == "New Name" and after["C1"].credit_score == -1
    assert after["C1"].created_at == date(2020, 1, 1)
    assert after["C2"] == before["C2"]
    assert after["C3"].customer_key == 4
    again = dimensions.build_dimension("dim_customer", batch, RUN, new)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, new.collect()))


def test_keys_are_dense_and_repeatable(spark):
    members = spark.range(5000).selectExpr("concat('id', id) as m")
    first = dense_keys(members, "m", "k", after=10, bucket_rows=20)
    again = dense_keys(members.repartition(13), "m", "k", after=10, bucket_rows=20)
    got = {r.m: r.k for r in first.collect()}
    assert sorted(got.values()) == list(range(11, 5011))
    assert got == {r.m: r.k for r in again.collect()}
    assert load_keys(members.repartition(7), "k").select("k").distinct().count() == 5000


def test_calendar(spark, dims):
    row = dims["dim_date"].filter("date_key = 20240106").first()
    assert tuple(row) == (20240106, date(2024, 1, 6), 6, "Saturday", 6, 1, "January", 1, 2024, True)
    assert dimensions.build_dim_date(spark).count() == 4748
    more = dimensions.ensure_dates(
        dims["dim_date"], spark.createDataFrame([(date(2024, 2, 29),), (date(2024, 1, 6),), (None,)], "d date")
    )
    assert more.count() == 32 and more.filter("date_key = 20240229 and day_of_month = 29").count() == 1


def test_latest_card_prefers_an_open_end(stg):
    assert {r.account_id: r.card_id for r in facts.latest_cards(stg["cards"]).collect()} == {"A1": "K2", "A2": "K4"}


def test_transactions_resolve_or_fall_back_to_unknown(transactions, dims):
    names = {d: ids(dims[d], d) for d in schemas.DIMENSIONS}
    got = {
        r.transaction_id: (
            names["dim_customer"][r.customer_key],
            names["dim_account"][r.account_key],
            names["dim_card"][r.card_key],
            names["dim_merchant"][r.merchant_key],
            names["dim_branch"][r.branch_key],
            r.date_key,
            r.amount_usd,
        )
        for r in transactions.collect()
    }
    assert got == {
        "T1": ("C1", "A1", "K2", "M1", "UNKNOWN", 20240102, Decimal("10.00")),
        # the staged customer id is " C2 " but accounts name "C2", which the dimension holds trimmed
        "T2": ("C2", "A2", "K4", "UNKNOWN", "UNKNOWN", 20240102, Decimal("0.01")),
        "T3": ("UNKNOWN", "A3", "UNKNOWN", "M2", "UNKNOWN", 20240106, Decimal("0.02")),
        "T4": ("UNKNOWN", "UNKNOWN", "UNKNOWN", "M1", "UNKNOWN", 20240106, Decimal("7.00")),
    }


def test_dates_outside_the_calendar_fail_or_are_set_aside(spark, stg, dims, by_account, transactions):
    short = dims | {"dim_date": dimensions.build_dim_date(spark, date(2024, 1, 1), date(2024, 1, 2))}
    with pytest.raises(Exception, match="date_key not in dim_date: 20240106"):
        facts.build_transactions(stg["transactions"], by_account, short).collect()
    kept = facts.build_transactions(stg["transactions"], by_account, short, "quarantine")
    assert sorted(r.transaction_id for r in kept.collect()) == ["T1", "T2"]
    outside = facts.outside_calendar(transactions, short["dim_date"], "date_key")
    assert sorted(r.transaction_id for r in outside.collect()) == ["T3", "T4"]


def test_insert_if_absent(transactions):
    stored = transactions.filter("transaction_id in ('T1', 'T2')")
    assert sorted(r.transaction_id for r in absent_from(transactions, stored, "transaction_id").collect()) == ["T3", "T4"]
    assert facts.insert_if_absent(transactions, None, "transaction_id") is transactions


def test_hot_keys_join_like_any_other(spark):
    rows = spark.range(3000).selectExpr(
        "concat('t', id) as t",
        "case when id % 3 = 0 then 'hot' when id % 7 = 0 then 'gone' when id % 50 = 1 then null else concat('k', id % 400) end as k",
    )
    table = spark.range(300).selectExpr("concat('k', id) as k", "id as v", "cast(null as string) as w").unionByName(
        spark.sql("select 'hot' as k, -1L as v, 'x' as w")
    )
    plain = rows.join(table, "k", "left").select("t", "k", "v", "w")
    for hot in (0.3, 0.02, 0.0):
        got = spread_lookup(rows, table, "k", "t", hot_share=hot, share=1.0).select("t", "k", "v", "w")
        assert Counter(map(tuple, got.collect())) == Counter(map(tuple, plain.collect()))
    small = lookup(rows, table, "k", "t").select("t", "k", "v", "w")
    large = lookup(rows, table, "k", "t", broadcast_bytes=10).select("t", "k", "v", "w")
    assert Counter(map(tuple, small.collect())) == Counter(map(tuple, large.collect()))
    assert frequent_keys(rows, "k", 0.3) == ["hot"]
    none = rows.limit(0)
    assert spread_lookup(none, table, "k", "t").count() == 0


def test_hot_rows_are_spread_over_tasks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(8000).selectExpr(
            "concat('t', id) as t",
            "case when id % 3 = 0 then 'k7' when id % 3 = 1 then 'gone' when id % 5 = 1 then null else concat('k', id % 400) end as k",
        )
        table = spark.range(300).selectExpr("concat('k', id) as k", "id as v")
        joined = spread_lookup(rows, table, "k", "t", hot_share=0.1, share=1.0)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2000
        assert joined.filter("v is not null").count() == rows.join(table, "k").count()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_held_tables_join_like_stored_ones(spark, stored, broadcast_bytes):
    """Hot, unmatched and null keys, and a key the table has twice; a large table is dealt out once, not for each batch."""
    table = stored(spark.range(300).selectExpr("concat('k', id % 299) as k", "id as v", "cast(null as string) as w"))
    kept = held(table, "k", broadcast_bytes)
    try:
        for n in range(3):
            rows = spark.range(1000).selectExpr(
                "concat('t', id) as t", f"case when id % 3 = {n} then 'k7' when id % 50 = 1 then null else concat('k', id % 400) end as k"
            )
            got = lookup(rows, kept, "k", "t").select("t", "k", "v", "w")
            assert Counter(map(tuple, got.collect())) == Counter(map(tuple, rows.join(table, "k", "left").select("t", "k", "v", "w").collect()))
        plan = got._jdf.queryExecution().executedPlan().toString()
        exchanges = plan.split("== Initial Plan ==")[-1].count("Exchange hashpartitioning")
        assert exchanges == (0 if broadcast_bytes else 1)
        assert ("InMemoryTableScan" in plan) == (not broadcast_bytes)
    finally:
        kept.release()
    assert "InMemoryTableScan" not in lookup(rows, table, "k", "t", broadcast_bytes=0)._jdf.queryExecution().executedPlan().toString()


def test_transactions_with_held_tables(stg, dims, by_account, transactions):
    for limit in (0, 1 << 20):
        tables = facts.held_tables(by_account, dims, limit)
        try:
            got = facts.build_transactions(stg["transactions"], by_account, dims, tables=tables)
            assert got.dtypes == facts.build_transactions(stg["transactions"], by_account, dims).dtypes
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, transactions.collect()))
        finally:
            tables.release()
    nobody = {d: rows.filter("false") if d == "dim_branch" else rows for d, rows in dims.items()}
    tables = facts.held_tables(by_account, nobody)
    rows = facts.build_transactions(stg["transactions"], by_account, nobody, tables=tables).collect()
    assert rows and {r.branch_key for r in rows} == {None}


@pytest.fixture(scope="module")
def loans(stg, dims, stored):
    return stored(load_keys(facts.build_loans(stg["loans"], dims), "loan_key"))


def test_loans(loans, dims):
    names = ids(dims["dim_customer"], "dim_customer")
    assert sorted((r.loan_id, names[r.customer_key], r.start_date_key) for r in loans.collect()) == [
        ("L1", "C1", 20240102),
        ("L2", "UNKNOWN", 20240102),
    ]


def test_customer_360(stg, dims, transactions, loans):
    mart = marts.customer_360(dims["dim_customer"], dims["dim_account"], stg["accounts"], transactions, loans)
    rows = {r.customer_id: r for r in mart.collect()}
    assert set(rows) == {"C1", "C2"}
    c1, c2 = rows["C1"], rows["C2"]
    assert (c1.credit_tier, c1.total_accounts, c1.total_transactions, c1.active_loans_count) == ("EXCELLENT", 1, 1, 1)
    assert (c1.total_spend_usd, c1.total_loan_debt_usd, c1.customer_segment) == (10, 100, "BRONZE_RETAIL")
    assert (c2.credit_tier, c2.total_balance_usd, c2.total_loan_debt_usd) == ("UNSCORED", 0, 0)


def test_without_an_unknown_member_nothing_is_spent(dims, transactions):
    no_unknown = dims["dim_customer"].filter("customer_id <> 'UNKNOWN'")
    assert marts.customer_spending(transactions, no_unknown).count() == 0


def test_rejected_rows_and_kept_rows_add_up(spark):
    rows = [("B1", "a", "x"), ("B1", "a", "x"), ("B1", "b", None), ("B2", None, "y"), (None, "n", "n")]
    batch = spark.createDataFrame(rows, "branch_id string, branch_name string, manager_name string")
    kept = dimensions.one_per_id(batch, "branch_id", "quarantine")
    rejected = dimensions.rejected_members(batch, "branch_id")
    assert sorted(map(tuple, rejected.collect()), key=str) == [("B1", "a", "x", 1), ("B1", "b", None, 1)]
    assert kept.count() + rejected.agg(F.sum("copies")).first()[0] == len(rows)


def test_demo_ids_past_six_digits_differ(spark, dims):
    batch = incremental.generate_batch(spark, dims, 1_000_020).select("transaction_id")
    assert batch.distinct().count() == 1_000_020
    assert batch.agg(F.max(F.length("transaction_id"))).first()[0] == len("TXN_DEMO_1000000")


def test_branch_marts(spark, dims, transactions):
    mart = marts.daily_branch_performance(dims["dim_date"], dims["dim_branch"], transactions, limit=1)
    assert mart.count() == 31
    day = mart.filter("full_date = date'2024-01-06'").first()
    assert (day.branch_id, day.daily_transactions_count, day.daily_transaction_volume_usd) == ("B1", 2, Decimal("7.02"))
    assert day.avg_ticket_size_usd == Decimal("3.51")
    own = marts.daily_branch_by_branch(dims["dim_date"], dims["dim_branch"], transactions)
    assert own.count() == 31 * 3
    by_branch = {r[0]: r[1] for r in own.groupBy("branch_id").sum("daily_transactions_count").collect()}
    assert by_branch == {"B1": 0, "B2": 0, "UNKNOWN": 4}


def test_merchant_and_risk_marts(dims, transactions, loans):
    merchants = {r.merchant_id: r for r in marts.merchant_analytics(dims["dim_merchant"], transactions).collect()}
    assert merchants["M1"].total_sales_volume_usd == 17 and merchants["M1"].estimated_interchange_fee_usd == Decimal("0.26")
    assert merchants["UNKNOWN"].total_transactions == 1 and merchants["M2"].min_txn_amount_usd == Decimal("0.02")
    risk = {r.credit_risk_tier: r for r in marts.credit_risk_monitoring(loans, dims["dim_customer"]).collect()}
    assert set(risk) == {"1. EXCELLENT (750 - 850)", "5. UNSCORED / GUEST"}
    assert risk["1. EXCELLENT (750 - 850)"].estimated_annual_interest_revenue_usd == 5
