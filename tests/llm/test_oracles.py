"""Queries with SQL against DuckDB."""

import pytest

from fixtures.check import duck, rows_of
from ledgermill.llm import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_oracle(spark, name):
    got = registry.QUERIES[name](spark, SF)
    answer = duck(SF).execute(registry.ORACLES[name])
    want = rows_of([d[0] for d in answer.description], answer.fetchall())
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == want
    assert want[1]


def test_every_query_runs_over_given_tables(spark):
    assert [int(n[2:].split("_")[0]) for n in registry.QUERIES] == list(range(1, 14))
    assert set(registry.ORACLES) <= set(registry.QUERIES)
