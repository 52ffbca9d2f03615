"""Every registered query against its oracle."""

import threading

import pytest

from fixtures import oracles, registry
from fixtures.check import compare, duck
from fixtures.workbench import Workbench
from ledgermill.operators import facts
from ledgermill.sources.layers import Layers

SF = "/root/testdata/sf0.001"
QUERIES = sorted(registry.registered())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_oracle(spark, con, name):
    ok, note, _ = compare(spark, con, name, SF)
    assert ok, note


def test_oracles_name_queries():
    assert set(oracles.all_oracles()) == set(QUERIES)


def test_loads_join_stored_ids_by_shuffles(spark, monkeypatch):
    """As over large tables, where neither the ids nor a dimension is broadcast."""
    from functools import partial

    monkeypatch.setattr(registry, "lookup", partial(registry.lookup, broadcast_bytes=0))
    run, again = registry.registered(), f"{SF}/../sf0.001"  # a workbench of its own
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loaded, whole = run["fact_insert_if_absent"](spark, again), run["fact_tx_build"](spark, again)
        assert loaded.exceptAll(whole).isEmpty() and whole.exceptAll(loaded).isEmpty() and not loaded.isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize(
    "name, built",
    [
        ("dq_fico_range", {"stg_customers", "dim_customer"}),
        ("dq_fk_loans", {"stg_customers", "stg_branches", "stg_loans", "dim_customer", "dim_branch", "dim_date", "fact_loans"}),
    ],
)
def test_checks_wait_for_their_own_tables_only(spark, name, built):
    bench = Workbench(spark, f"{SF}/../sf0.001/{'./' * len(name)}")
    assert registry.REGISTRY[name](bench).count() == len(registry.REGISTRY[name](bench).collect()) > 0
    assert set(bench._schemas) == built


def test_stream_opens_its_tables_before_it_starts(spark, monkeypatch):
    """The stream's thread needs the workbench for nothing, neither in its first batch nor later, and sends no large table to the driver."""
    bench, main, asked, limits = Workbench(spark, f"{SF}/../sf0.001/./../sf0.001"), threading.get_ident(), [], []
    stored, build = Workbench.stored, facts.build_transactions

    def noted(self, name, rows):
        if threading.get_ident() != main:
            asked.append(name)
            raise RuntimeError(f"{name} is asked for by the stream")  # it would wait forever
        return stored(self, name, rows)

    def built(*args, **options):
        limits.append(options["broadcast_bytes"])
        return build(*args, **options)

    monkeypatch.setattr(Workbench, "stored", noted)
    monkeypatch.setattr(facts, "build_transactions", built)
    assert registry.REGISTRY["stream_fact_load"](bench).count() > 0
    assert not asked and limits and max(limits) <= 4 << 20


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_keys_turn_back_into_ids_from_stored_rows(spark, monkeypatch):
    """Hot keys are counted on rows that are written down, not on a fact that is built again for each dimension."""
    counted = []

    def lookup(rows, table, key, spread_by, seen=None, **more):
        counted.append((rows if seen is None else seen)._jdf.queryExecution().optimizedPlan().toString())
        return joined(rows, table, key, spread_by, seen, **more)

    joined = registry.lookup
    monkeypatch.setattr(registry, "lookup", lookup)
    bench = Workbench(spark, f"{SF}/../sf0.001/././.")
    assert registry.REGISTRY["fact_tx_build"](bench).count() > 0
    assert len(counted) == len(registry.TRANSACTION_IDS)
    assert not [plan for plan in counted if "Join" in plan or "Aggregate" in plan]


@pytest.mark.parametrize("name", ["src_discover", "src_ingest"])
def test_tables_read_once_are_not_written_first(spark, name):
    bench = Workbench(spark, f"{SF}/../sf0.001/{'./' * (len(name) + 20)}")
    assert registry.REGISTRY[name](bench).count() == 7
    assert not bench._schemas


def test_staging_is_written_in_its_layer_only(spark):
    bench = Workbench(spark, f"{SF}/../sf0.001/{'./' * 40}")
    layers = Layers(spark, f"{bench.root}/staged")
    registry.stage(bench, layers, bench.settings())
    assert set(layers.tables("staging")) == set(bench.staging()) and not bench._schemas


def test_tables_of_the_fact_are_written_side_by_side(spark, monkeypatch):
    """Transactions are staged while accounts and their keys are, each once."""
    bench, build, asked, accounts, met = Workbench(spark, f"{SF}/../sf0.001/{'./' * 41}"), Workbench.build, [], threading.Event(), []

    def noted(self, name):
        asked.append(name)
        if name == "stg_accounts":
            accounts.set()
        if name == "stg_transactions":
            met.append(accounts.wait(30))
        return build(self, name)

    monkeypatch.setattr(Workbench, "build", noted)
    assert bench["fact_transactions"].count() > 0
    assert met == [True] and len(asked) == len(set(asked))
