"""Operators without SQL against brute force, and laws their results keep."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import ann, common, decontamination, mixing, sharding, simhash, substrings
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.01"


def smallest_reachable(values, linked):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in itertools.combinations(values, 2):
        if linked(a, b):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    return {v: root(v) for v in values}


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, 5000)]
    found = common.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    wanted = {frozenset(e) for e in edges if e[0] != e[1]}
    nodes = sorted({n for e in wanted for n in e})
    assert {r.node: r.component for r in found.collect()} == smallest_reachable(nodes, lambda a, b: frozenset((a, b)) in wanted)


def test_numbers_have_no_gap(spark):
    rows = spark.range(1000).selectExpr("id % 3 as g", "id as k").unionByName(spark.range(5).selectExpr("0L as g", "0L as k"))
    got = common.numbered(rows, "g", "k", "n", per_task=50).groupBy("g").agg(F.collect_list("n").alias("n")).collect()
    assert all(sorted(r.n) == list(range(len(r.n))) for r in got) and len(got) == 3


@pytest.mark.parametrize("hot", [512, 3])
def test_links_lose_nothing(spark, settings, hot):
    """Near copies by the hundred, all ways a pair can differ, with and without hot buckets."""
    settings(simhash, "HOT", hot)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for b in base[:6]:
        prints |= {b ^ (1 << i) ^ (1 << j) for i, j in itertools.combinations(rng.sample(range(64), 12), 2)}
        prints |= {b ^ (0b111 << rng.randrange(60)) for _ in range(10)}
    prints |= {0, 3, (1 << 64) - 1, (1 << 63), 1 << 31 | 1 << 32}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    edges = {tuple(sorted(e)) for e in simhash.links(frame).collect()}
    near = lambda a, b: bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 2
    wanted = {tuple(sorted(e)) for e in itertools.combinations(signed, 2) if near(*e)}
    assert edges == wanted
    groups = {r.node: r.component for r in common.components(simhash.links(frame)).collect()}
    by_hand = smallest_reachable(sorted(signed), near)
    assert all(groups.get(p, p) == c for p, c in by_hand.items())


def test_fingerprints(spark):
    import xxhash

    def plain(text, n=3):
        words = "".join(c.lower() if c.isascii() else c for c in text).split(" ")
        words = [w for w in words if w]
        grams = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))

    for text in ("", "One", "One TWO", "a b c d É ß Ünter x x x x", prose(3, 200)):
        assert simhash.fingerprint(text) & ((1 << 64) - 1) == plain(text)
    assert simhash.fingerprint(None) == 0


def test_seeds_find_every_pair_of_substitutions():
    for a, b in itertools.combinations(range(decontamination.WINDOW), 2):
        assert any(
            not {a, b} & {at + o for o in mask}
            for mask in decontamination.MASKS
            for at in range(decontamination.WINDOW - mask[-1])
        )


def test_substituted_passages_are_found(spark):
    rng = random.Random(1)
    tests = [(k, prose(k + 50, 40)) for k in range(8)]
    docs, wanted = [], set()
    for n in range(60):
        item = n % 8
        words = tests[item][1].split()[5:18]
        for at in rng.sample(range(13), n % 5):
            words[at] = f"other{at}"
        docs.append((n, f"{prose(n + 500, 30)} {' '.join(words).upper()}, {prose(n + 900, 20)}"))
        if n % 5 <= 2:
            wanted.add((n, item))
    found = decontamination.contamination(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(tests, "item_id bigint, text string")
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted
    assert all(r.matched >= 13 - r.doc_id % 5 for r in found)


@pytest.mark.parametrize("chunk, part", [(1 << 20, 24 << 20), (50, 300)])
def test_repeats_are_removed_whole(spark, settings, chunk, part):
    settings(substrings, "CHUNK", chunk)
    settings(substrings, "PART_BYTES", part)
    rng = random.Random(chunk)
    common_part = prose(7, 60).split()
    docs = []
    for n in range(40):
        words = [f"w{n}v{k}" for k in range(rng.randrange(30))]
        for _ in range(rng.randrange(4)):
            at, size = rng.randrange(40), rng.randrange(5, 30)
            words += common_part[at : at + size] + [f"u{n}z{rng.random()}"]
        words += ["ha"] * rng.randrange(30)
        docs.append((n * 3 - 20, words))
    first = {}
    for doc_id, words in docs:
        for k in range(len(words) - 12):
            key = tuple(words[k : k + 13])
            first[key] = min(first.get(key, doc_id), doc_id)
    wanted = {}
    for doc_id, words in docs:
        gone = set()
        for k in range(len(words) - 12):
            if first[tuple(words[k : k + 13])] < doc_id:
                gone |= set(range(k, k + 13))
        wanted[doc_id] = (len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone))
    frame = spark.createDataFrame([(d, " ".join(w)) for d, w in docs], "doc_id bigint, text string").repartition(5)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.without_repeats(frame).collect()}
    assert found == wanted and any(r[1] for r in wanted.values())


def test_shards_are_even_and_keep_copies_together(spark):
    rows = sharding.op3_kd_sharding(spark, SF).collect()
    size, groups = np.zeros(8), {}
    for r in rows:
        size[r.shard] += r.size
        groups.setdefault((r.text_crc32, r.size), set()).add(r.shard)
    assert size.max() / size.mean() < 1.05 and size.min() / size.mean() > 0.95
    assert all(len(s) == 1 for s in groups.values())
    for shard in range(8):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))


def test_a_group_too_large_for_a_shard_is_split(spark):
    rows = [(k, "same text" if k % 3 == 0 else f"text {k}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sizes = [r[1] for r in sharding.kd_shards(docs, shards=8).groupBy("shard").agg(F.sum("size")).collect()]
    assert len(sizes) == 8 and max(sizes) / (sum(sizes) / 8) < 1.1
    odd = sharding.kd_shards(docs, shards=5).groupBy("shard").agg(F.sum("size")).collect()
    assert len(odd) == 5 and max(r[1] for r in odd) / (sum(r[1] for r in odd) / 5) < 1.1


def test_targets_are_shared_by_weight_below_their_caps(spark):
    sources = [("b", 100), ("a", 10), (None, 50), ("c", 40), ("é", 0)]
    got = mixing.targets(spark.createDataFrame(sources, "source string, source_size bigint")).collect()
    target = {r.source: r.target for r in got}
    sizes, weights = dict(sources), dict(zip(("a", "b", "c", "é", None), (5, 2, 1, 5, 2), strict=True))
    assert sum(target.values()) == pytest.approx(300)
    free = {s: t / weights[s] for s, t in target.items() if t < 2 * sizes[s]}
    assert max(free.values()) == pytest.approx(min(free.values()))
    assert all(t <= 2 * sizes[s] and (t / weights[s] <= max(free.values()) + 1e-9) for s, t in target.items())


@pytest.mark.parametrize("group", [2000, 7])
def test_words_come_near_their_targets(spark, settings, group):
    settings(mixing, "GROUP_ROWS", group)
    settings(mixing, "FAN_IN", 3)
    rows = mixing.op2_pivotal_mixing(spark, SF).collect()
    taken, sources, largest = {}, {}, {}
    for r in rows:
        largest[r.source_size] = max(largest.get(r.source_size, 0), r.size)
        assert r.taken % max(1, r.size) == 0 and 0 <= r.taken <= 2 * r.size
        sources[r.source_size] = r.target
        taken[r.source_size] = taken.get(r.source_size, 0) + r.taken
    # in groups of seven the last one has few rows to make up for a long one
    assert all(abs(taken[s] - t) < 0.01 * t + (group < 100) * largest[s] / 2 for s, t in sources.items())
    again = mixing.op2_pivotal_mixing(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_short_rows_make_up_for_a_long_one_at_every_size(spark, settings):
    settings(mixing, "GROUP_ROWS", 50)
    settings(mixing, "FAN_IN", 3)
    rows = [(k, "w " * (3000 if k % 100 == 0 else 1 + k % 20), "abc"[k % 3]) for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    for seed in (1, 2):
        found = mixing.copies(docs, seed).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")), F.first("target"), F.count("*")).collect()
        assert len(found) == 3 and all(abs(taken - target) <= 1 and n == 1000 for _, taken, target, n in found), found


def test_pivots_keep_sums_and_expectations():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 50, 11).astype(float)
    total = np.zeros(11)
    for _ in range(4000):
        part = np.full(11, 0.3)
        left = mixing.pivot(size, part, rng.random(11))
        assert abs((size * part).sum() - 0.3 * size.sum()) < 1e-6
        assert sum(0 < p < 1 for p in part) <= 1 and (left < 0 or 0 < part[left] < 1)
        total += part
    assert np.abs(total / 4000 - 0.3).max() < 0.04


def test_found_neighbours_are_near_all_true_ones(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    found = {}
    for r in ann.op4_kmeans_tree(spark, SF).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = []
    for q in ids[ids % 20 == 0]:
        scores = np.einsum("ij,j->i", vectors, vectors[ids == q][0])
        order = [k for k in np.lexsort((ids, -scores)) if ids[k] != q][:20]
        got = found[q]
        assert len(got) == 20 and got == sorted(got, key=lambda x: (-x[1], x[0]))
        assert all(abs(s - scores[ids == v][0]) < 1e-12 for v, s in got)
        hits.append(len({v for v, _ in got} & set(ids[order])) / 20)
    assert np.mean(hits) >= 0.9


def test_a_common_vector_is_split_over_blocks(spark, settings):
    settings(ann, "BLOCK", 50)
    rng = np.random.default_rng(1)
    rows = [(k, [1.0, 2.0, 3.0] if k % 3 else [float(x) for x in rng.normal(size=3)]) for k in range(600)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.nearest(vectors, vectors.where("vec_id % 100 = 1"), count=5, leaf_rows=20).orderBy("query_id", "rank").collect()
    assert [r.vec_id for r in got if r.query_id == 1] == [2, 4, 5, 7, 8]


@pytest.mark.parametrize("words", [1, 40])
def test_a_group_hands_up_few_rows_whatever_its_rows_are(words):
    """One document of very many words beside short ones: the tree shrinks all the same."""
    size = np.array([200_000.0] + [float(words)] * 2_000)
    part = np.array([0.5] + [0.0, 1.0] * 1_000)
    up = mixing.spare(size, part, 100_000.0, 64)
    assert not up[0]
    assert up.sum() == 2 * 64
    mixed = np.sort(np.random.default_rng(3).integers(1, 5_000, 2_001))[::-1].astype(float)
    up = mixing.spare(mixed, part, 1e9, 64)
    powers = {(side, int(np.log2(s))) for s, side in zip(mixed[up], part[up], strict=True)}
    assert {(side, k) for side in (0.0, 1.0) for k in range(6, 13)} <= powers
    assert up.sum() <= 2 * (64 + 13 * mixing.RUNG)


def test_a_long_document_beside_short_ones_leaves_a_small_miss(spark, settings):
    """Groups of a source meet with rows that make up for its longest document together."""
    settings(mixing, "GROUP_ROWS", 200)
    settings(mixing, "FAN_IN", 8)
    rows = [(0, "w " * 6_000, "a")] + [(k, "w " * (20 + k % 30), "a") for k in range(1, 3_000)] + [(k, "w", "b") for k in range(3_000, 3_500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    for seed in (1, 2):
        taken = mixing.copies(docs, seed).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")), F.first("target")).collect()
        for _, got, target in taken:
            assert abs(got - target) <= 25
