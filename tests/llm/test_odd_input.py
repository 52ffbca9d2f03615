"""Nulls, empty and long texts, repeated rows, clashing names and empty tables, for every operator."""

import hashlib

import pytest
from pyspark.sql import functions as F

from ledgermill.llm import ann, decontamination, licenses, lines, mixing, quality, sharding, simhash, substrings, toxicity
from tests.llm.conftest import prose


def labels(spark):
    return spark.createDataFrame([(1, 1), (3, 0), (6, 1), (7, 0), (99, 1), (None, 1)], "doc_id bigint, toxic int")


def trusted(spark):
    return spark.createDataFrame([(1,), (6,), (10,), (None,)], "doc_id bigint")


def benchmark(spark):
    return spark.createDataFrame([(1, prose(4)), (2, None), (3, ""), (4, prose(4)), (5, "word")], "item_id bigint, text string")


PER_ROW = {
    "quality": lambda s, d: quality.quality_scores(d, trusted(s)),
    "copies": lambda s, d: mixing.copies(d),
    "shards": lambda s, d: sharding.kd_shards(d, shards=4),
    "near_duplicates": lambda s, d: simhash.near_duplicates(d),
    "substrings": lambda s, d: substrings.without_repeats(d),
    "lines": lambda s, d: lines.without_repeated_lines(d),
    "licenses": lambda s, d: licenses.license_scan(d),
    "toxicity": lambda s, d: toxicity.toxicity_scores(d, labels(s)),
}
FILTERS = {
    "accepted": lambda s, d: quality.accepted(d, trusted(s)),
    "mixed": lambda s, d: mixing.mixed(d),
    "sharded": lambda s, d: sharding.sharded(d, shards=4),
    "first_of_each": lambda s, d: simhash.first_of_each(d),
    "decontaminated": lambda s, d: decontamination.decontaminated(d, benchmark(s)),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_a_row_for_every_row(spark, odd_docs, no_docs, name):
    found = PER_ROW[name](spark, odd_docs)
    ids = sorted(r.doc_id or 0 for r in found.select("doc_id").collect())
    assert ids == sorted(r.doc_id or 0 for r in odd_docs.select("doc_id").collect())
    assert PER_ROW[name](spark, no_docs).collect() == []


@pytest.mark.parametrize("name", FILTERS)
def test_all_columns_stay_as_they_are(spark, odd_docs, no_docs, name):
    found = FILTERS[name](spark, odd_docs)
    assert [c for c in found.columns if c != "shard"] == odd_docs.columns
    given = {tuple(r) for r in odd_docs.collect()}
    assert {tuple(r) for r in found.select(*odd_docs.columns).collect()} <= given
    assert FILTERS[name](spark, no_docs).collect() == []


def test_one_of_each_group_stays(spark, odd_docs):
    kept = sorted((r.doc_id, r.text) for r in simhash.first_of_each(odd_docs).collect())
    # 1 stands for 6, 7 and the one without an id; 2 for all without words
    assert [k for k, _ in kept] == [1, 2, 5, 7, 8, 9, 10]
    groups = {(r.doc_id, r.fp): r.component_id for r in simhash.near_duplicates(odd_docs).collect()}
    assert {c for (i, f), c in groups.items() if f == 0} == {2}


def test_only_the_document_with_a_passage_goes(spark, odd_docs):
    kept = decontamination.decontaminated(odd_docs, benchmark(spark)).collect()
    gone = {r.doc_id for r in odd_docs.collect()} - {r.doc_id for r in kept}
    assert gone == {5, 8, 10}
    found = decontamination.contamination(odd_docs, benchmark(spark)).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(5, 1), (5, 4), (8, 5), (10, 1), (10, 4)]


def test_nothing_is_in_an_empty_benchmark(spark, odd_docs):
    none = benchmark(spark).limit(0)
    assert decontamination.decontaminated(odd_docs, none).count() == odd_docs.count()


def test_null_texts_have_defined_digests(spark, odd_docs):
    found = {r.doc_id: r for r in substrings.without_repeats(odd_docs.where("doc_id in (2, 3, 4, 8)")).collect()}
    assert [(found[k].n_words, found[k].kept) for k in (2, 3, 4, 8)] == [(0, ""), (0, ""), (0, ""), (1, "word")]
    found = {r.doc_id: r for r in lines.without_repeated_lines(odd_docs.where("doc_id in (2, 3, 4)")).collect()}
    assert [(found[k].n_lines, found[k].kept) for k in (2, 3, 4)] == [(0, None), (1, ""), (2, " \n\t ")]


def test_repeated_rows_do_not_remove_each_other(spark, odd_docs):
    five = substrings.without_repeats(odd_docs.where("doc_id = 5")).collect()
    assert [r.n_removed for r in five] == [0, 0] and five[0].n_words > 50_000
    ten = lines.without_repeated_lines(odd_docs.where("doc_id = 10")).first()
    assert (ten.n_lines, ten.n_removed) == (8, 4)


def test_shards_hold_every_row_once(spark, odd_docs):
    rows = sharding.kd_shards(odd_docs, target_bytes=1 << 20).collect()
    assert len({(r.shard, r.slot) for r in rows}) == odd_docs.count()
    empty = next(r for r in rows if r.doc_id == 2)
    assert (empty.size, empty.text_crc32) == (1, 0)


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (20, [1.0, 0.0]), (40, [0.0, 0.0]), (60, None), (80, [nan, 1.0]), (100, [inf, 1.0]), (120, [None, 1.0]),
        (None, [1.0, 1.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, [-1.0, 0.0]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("leaf", F.lit("x"))
    found = ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), count=20).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == [(20, 1, 1, 0.5), (20, 2, 2, 0.5), (20, 3, 3, -1.0)]
    assert ann.nearest(vectors.limit(0), vectors).collect() == []
    assert ann.nearest(vectors, vectors.limit(0)).collect() == []
    with pytest.raises(ValueError, match="numbers"):
        ann.nearest(vectors.unionByName(spark.createDataFrame([(9, [1.0])], "vec_id bigint, embedding array<float>").withColumn("leaf", F.lit("x"))), vectors)


def test_sha_is_of_the_utf8_text(spark):
    docs = spark.createDataFrame([(1, "é  à\nb")], "doc_id bigint, text string")
    kept = substrings.without_repeats(docs).select(F.sha2(F.encode("kept", "UTF-8"), 256)).first()[0]
    assert kept == hashlib.sha256("é à b".encode()).hexdigest()


def test_slots_have_no_gaps_where_ids_are_null_or_equal(spark):
    docs = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL WHEN id % 3 = 1 THEN 7 ELSE id END AS doc_id", "repeat('ab ', CAST(id % 50 AS INT)) AS text")
    slots = {}
    for r in sharding.kd_shards(docs, shards=4).collect():
        slots.setdefault(r.shard, []).append(r.slot)
    assert sum(map(len, slots.values())) == 3000 and all(sorted(s) == list(range(len(s))) for s in slots.values())
