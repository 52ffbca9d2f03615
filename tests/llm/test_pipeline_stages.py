"""The whole run against its stages worked out by hand."""

import corpus_pipeline
from ledgermill.llm.common import table, written
from ledgermill.llm.decontamination import MASKS, WINDOW

SF = "/root/testdata/sf0.01"


def words(text):
    import re

    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower()) if w]


def test_each_stage_takes_effect(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier",
        "SimHash near-dedup",
        "benchmark decontamination",
        "mixing sources to target weights",
        "sharding",
    ]
    docs = table(spark, SF, "documents")
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES:
        kept.append(written(stage(spark, kept[-1], SF)))
        if len(kept) < 6:
            assert kept[-1].columns == docs.columns
    ids = [[r.doc_id for r in k.select("doc_id").collect()] for k in kept]
    quality = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    dropped = set(ids[0]) - set(ids[1])
    assert sum(quality.get(i) == 1 for i in dropped) <= 0.01 * sum(quality.values())
    assert sum(quality[i] == 0 for i in set(ids[1]) & set(quality)) <= 0.05 * len(quality)
    texts = {r.doc_id: r.text for r in docs.collect()}
    first = {}
    for i in sorted(ids[1]):
        first.setdefault(texts[i], i)
    assert set(ids[2]) <= set(first.values()) and len(set(ids[2])) == len(ids[2])
    passages = {tuple(w[k : k + WINDOW]) for w in (words(r.text) for r in table(spark, SF, "benchmark").collect()) for k in range(len(w) - WINDOW + 1)}
    held = {i for i in ids[2] if any(tuple(w[k : k + WINDOW]) in passages for w in [words(texts[i])] for k in range(len(w) - WINDOW + 1))}
    assert held and held == set(ids[2]) - set(ids[3])
    counts = {i: ids[4].count(i) for i in ids[3]}
    assert set(ids[4]) <= set(ids[3]) and max(counts.values()) <= 2
    size = {i: len(texts[i].split()) for i in ids[3]}
    assert abs(sum(size[i] * n for i, n in counts.items()) - 1.5 * sum(size.values())) < 0.02 * sum(size.values())
    assert sorted(ids[5]) == sorted(ids[4])
    per_shard = {}
    for r in kept[5].select("shard", "text").collect():
        per_shard[r.shard] = per_shard.get(r.shard, 0) + len(r.text.encode()) + 1
    assert sorted(per_shard) == list(range(8)) and max(per_shard.values()) < 1.1 * sum(per_shard.values()) / 8
    assert MASKS


def test_run_is_its_stages(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == [*table(spark, SF, "documents").columns, "shard"] and out.count() > 0
