"""Notices across line breaks, held against every block counted one by one."""

import random

import pytest

from ledgermill.llm import licenses
from ledgermill.llm.licenses import TEMPLATES, license_blocks, license_scan, needed, notices, stride_of, tokens_of

BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met"""


def scanned(spark, texts, **options):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r for r in license_scan(rows, **options).collect()}


def brute_force(text, templates, threshold):
    words, found = tokens_of(text), set()
    for template, label in templates.items():
        wanted = tokens_of(template)
        stride = stride_of(len(wanted))
        for first in range(0, len(words), stride):
            common = len(set(wanted) & set(words[first : first + 2 * stride]))
            if common >= needed(len(set(wanted)), threshold):
                found.add((first, 2 * stride, label, common / len(set(wanted))))
    best = {}
    for first, size, label, share in found:
        best[first, size, label] = max(share, best.get((first, size, label), 0))
    return best


def test_a_wrapped_notice_is_found_and_scattered_words_are_not(spark):
    scattered = " ".join(w if k % 900 == 0 else f"w{k}" for k, w in ((k, ("all", "rights", "reserved")[k // 900 % 3]) for k in range(9_000)))
    per_word = "\n".join(BSD.split())
    found = scanned(spark, [BSD, per_word, scattered, None, "", "released under\r\n\tthe MIT\n\nlicense"])
    assert [found[k].labels for k in range(6)] == ["bsd", "bsd", "", "", "", "mit"]
    assert found[0].score == found[1].score == 1.0
    assert (found[2].n_base, found[2].score) == (0, 0.0)


def test_a_notice_is_found_wherever_it_starts(spark):
    notice = next(t for t, label in TEMPLATES.items() if label == "mpl")
    texts = [" ".join(["filler"] * before + [notice, "tail"]) for before in range(70)]
    assert {r.labels for r in scanned(spark, texts).values()} == {"mpl"}


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
def test_blocks_are_those_counted_one_by_one(spark, threshold):
    dice = random.Random(5)
    pool = sorted({w for t in TEMPLATES for w in t.split()}) + ["other", "words"]
    texts = [" ".join(dice.choices(pool, k=dice.randrange(60))) for _ in range(60)]
    texts += [" ".join([*dice.choices(pool, k=dice.randrange(9)), t.upper(), *dice.choices(pool, k=5)]) for t in TEMPLATES]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = license_blocks(rows, threshold=threshold).collect()
    for k, text in enumerate(texts):
        mine = {(r.first_word, r.n_words, r.label): r.containment for r in found if r.doc_id == k}
        assert mine == pytest.approx(brute_force(text, TEMPLATES, threshold))
    assert any(r.first_word for r in found)


def test_whole_notices_come_from_a_table(spark):
    long = " ".join(f"Clause{k}," for k in range(300))
    rows = [(long, "long"), (long, "zulu"), (None, "none"), ("...", "none"), ("kept", None), ("All, rights", "short")]
    taken = notices(spark.createDataFrame(rows, "text string, label string"))
    assert taken == {long: "long", "All, rights": "short"}
    held = "\n".join(["before"] * 333 + long.lower().split()[:250])
    found = scanned(spark, [held, " ".join(long.split()[:230])], templates=taken)
    assert [found[k].labels for k in (0, 1)] == ["long", ""]


def test_templates_without_words_are_refused(spark):
    rows = spark.createDataFrame([(1, "a")], "doc_id bigint, text string")
    for templates in ({}, {"--": "none"}):
        with pytest.raises(ValueError):
            license_scan(rows, templates=templates)


def test_rare_words_come_from_all_texts(spark):
    """Whatever is frequent, filters lose nothing: a template of common words only."""
    texts = ["to be or not to be"] * 50 + ["or\nnot\nbe"]
    found = scanned(spark, texts, templates={"to be or not": "hamlet"}, threshold=0.75)
    assert {r.labels for r in found.values()} == {"hamlet"}
    assert licenses.stride_of(4) == 4
