"""The audit against filters applied one after the other, and tries against sets."""

import re
from itertools import permutations

import pytest
from hypothesis import given
from hypothesis import settings as examples
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgermill.llm import filter_audit as fa
from tests.llm.conftest import SCHEMA, document, prose


def plainly(docs, labels):
    """Each order applied to the rows themselves."""
    last = float("inf")
    rows = [(last if r.doc_id is None else r.doc_id, r.text or "", r.source or "") for r in docs]
    least, good, bad = {}, set(), set()
    for i, text, _ in rows:
        least[text] = min(i, least.get(text, last))
    for r in labels:
        good |= {r.doc_id} if r.quality == 1 else set()
        bad |= {r.doc_id} if r.toxic == 1 else set()
    fails = []
    for i, text, part in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = (
            ("A", len(w) < 50), ("B", 100 * len(set(w)) < 65 * len(w)), ("C", 100 * len(re.findall("[A-Z]", text)) > 5 * len(text)),
            ("D", re.search(r"[#$%&*|]", text)), ("E", i > least[text]),
        )
        fails.append({f for f, no in failed if no})
    out, shapley = {}, {}
    parts = {p for *_, p in rows}
    for order in map("".join, permutations("ABCDE")):
        for part in parts:
            alive = [k for k, r in enumerate(rows) if r[2] == part]
            gone = []
            for step, f in enumerate(order, 1):
                removed = [k for k in alive if f in fails[k]]
                redundant = sum(f in fails[k] for k in gone)
                alive, gone = [k for k in alive if f not in fails[k]], gone + removed
                alone = sum(fails[k] == {f} for k, r in enumerate(rows) if r[2] == part)
                out[part, order, step] = (
                    len(alive), len(removed), redundant, alone, sum(rows[k][0] in good for k in removed), sum(rows[k][0] in bad for k in removed),
                )
                shapley[part, f] = shapley.get((part, f), 0) + len(removed)
    return {(*key, *value, shapley[key[0], key[1][key[2] - 1]]) for key, value in out.items()}


def labelled(spark):
    rows = [(1, 1, 0), (5, 1, 1), (7, 0, 1), (7, 1, None), (None, 1, 1), (99, 1, 1), (20, None, 1), (30, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int").withColumns({n: F.lit("z") for n in ("part", "mask", "n", "good")})


def found(docs, labels, **more):
    rows = fa.audited(docs, labels, **more)
    order = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return {tuple(r[c] for c in order) for r in rows.collect()}


def many(spark):
    rows = [document(k, prose(k % 17) + " Q#" * (k % 3), source=("a", "b", None, "")[k % 4]) for k in range(60)]
    rows += [document(100 + k % 50, prose(3), source="a") for k in range(120)]  # one text holds most rows, ids twice
    rows += [document(300, "x" * 5000 + "y"), document(301, "x" * 5000 + "z"), document(302, "x" * 5000), document(303, "x" * 5000)]
    return spark.createDataFrame(rows, SCHEMA).repartition(7, "doc_id")


@pytest.mark.parametrize("part_bytes", [fa.PART_BYTES, 500])
def test_counts_are_those_of_filters_applied_in_turn(spark, odd_docs, part_bytes):
    for docs in (many(spark), odd_docs):
        got = found(docs, labelled(spark), part_bytes=part_bytes)
        assert got == plainly(docs.collect(), labelled(spark).collect())
        assert len(got) == 600 * len({r.source or "" for r in docs.collect()})


def test_small_tries_give_the_same(spark, settings):
    docs = many(spark)
    want = sorted(tuple(r) for r in fa.flagged(docs).collect())
    settings(fa, "TRIE_ROWS", 9)
    settings(fa, "BATCH_ROWS", 2)
    assert sorted(tuple(r) for r in fa.flagged(docs, part_bytes=300).collect()) == want


def test_no_documents(spark, no_docs):
    assert fa.audited(no_docs, labelled(spark)).collect() == []


def test_no_labels(spark):
    rows = fa.audited(many(spark), labelled(spark).limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost"), F.count("*")).first()
    assert tuple(rows) == (0, 0, 2400)


def test_heavy_prefixes_are_lengthened(spark):
    rows = many(spark).select(F.encode("text", "UTF-8").alias("text")).where("text IS NOT NULL")
    prefix, parts = fa.adaptive_prefix(rows, 4000)
    assert parts > 1
    sizes = rows.select(prefix.alias("p"), "text").groupBy("p").agg(F.sum(F.length("text")).alias("b"), F.count_distinct("text").alias("n"), F.max(F.length("text")).alias("most"))
    # a prefix holds more only where it is a whole text
    assert all(r.b <= 4000 or r.n == 1 or len(r.p) >= 1024 for r in sizes.collect())
    assert sizes.count() == len({bytes(r.p) for r in sizes.collect()}) > 10


@examples(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="ab\0é", max_size=8), st.integers(0, 9)), max_size=40))
def test_trie_is_a_map(rows):
    trie, want = fa.Trie(), {}
    for text, i in rows:
        assert trie.insert(text.encode(), (False, i), i) == (text.encode() not in want)
        want.setdefault(text.encode(), []).append(i)
    got = {text: (least[1], [row for _, row in members]) for text, least, members in trie.terminals()}
    assert got == {text: (min(ids), ids) for text, ids in want.items()}
