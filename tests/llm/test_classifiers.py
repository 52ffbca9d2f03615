"""Held-out accuracy and the parts of the classifiers."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgermill.llm import quality, toxicity
from ledgermill.llm.common import learns

SF = "/root/testdata/sf0.1"


def held_out(spark, scores, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    rows = scores.where("held_out").join(labels, "doc_id").select("score", "predicted", label).collect()
    return np.array([tuple(r) for r in rows], float).T


def auc(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1.0
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / good.sum() / (~good).sum()


def test_quality_of_unseen_documents(spark):
    score, predicted, label = held_out(spark, quality.op1_pu_quality(spark, SF), "quality")
    assert auc(score, label) > 0.98 and (predicted == label).mean() > 0.97


def test_the_prior_is_found_and_the_risk_is_learnt():
    rng = np.random.default_rng(0)
    good = rng.normal(1.5, 1, (3000, 4))
    mixed = np.concatenate([rng.normal(1.5, 1, (2100, 4)), rng.normal(-1.5, 1, (900, 4))])
    assert quality.estimated_prior(good, mixed) == pytest.approx(0.7, abs=0.06)
    net = quality.train(good, mixed, 0.7, 0)
    assert (net.margin(rng.normal(1.5, 1, (1000, 4))) > 0).mean() > 0.95
    assert (net.margin(rng.normal(-1.5, 1, (1000, 4))) < 0).mean() > 0.95


def test_labels_of_other_rows_are_not_read(spark):
    ids = spark.range(300).select(F.col("id").alias("doc_id")).withColumn("kept", learns(F.col("doc_id")))
    import zlib

    assert all(r.kept == (zlib.crc32(str(r.doc_id).encode()) % 3 != 1) for r in ids.collect())
    assert not spark.range(1).select(learns(F.lit(None).cast("bigint"))).first()[0]


def test_toxicity_of_unseen_documents(spark):
    score, predicted, label = held_out(spark, toxicity.op10_toxicity(spark, SF), "toxic")
    assert auc(score, label) > 0.93 and (predicted == label).mean() > 0.95


@pytest.fixture(scope="module")
def decoder(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = np.zeros(toxicity.SYMBOLS**3, np.int64)
    for r in toxicity.trigram_counts(docs).collect():
        counts[r["trigram"]] = r["n"]
    return toxicity.Decoder(toxicity.language_model(counts))


def test_disguised_words_are_read(decoder):
    for disguised, meant in {
        "1d10t": "idiot", "stup1d": "stupid", "m0r0n": "moron", "l0ser": "loser", "tr4sh": "trash", "iiidiooot": "idiot",
        "s-t-u-p-i-d": "stupid", "clown!!!": "clown", "scum###": "scum", "idiot.": "idiot", "(loser)": "loser",
        "idi\u200bot": "idiot", "m\u043er\u043en": "moron", "l.o.s.e.r": "loser", "TR@SH": "trash",
    }.items():
        assert meant in decoder.words(f"The {disguised} was"), (disguised, decoder.words(disguised))
    assert "idiot" in decoder.words("an i d i o t was") and "stupid" in decoder.words("S T U P I D")
    assert decoder.words("") == decoder.words(None) == decoder.words("### %%%") == set()
    assert decoder.words("Plain words, stay.") == {"plain", "words", "stay"}


def test_doubled_letters_and_any_spacing_are_read(decoder):
    for disguised, meant in {
        "iiddiioott": "idiot", "sstupid": "stupid", "stuupid": "stupid", "st upid": "stupid", "id iot": "idiot", "i di ot": "idiot",
        "i, d, i, o, t": "idiot", "s tupid": "stupid", "mo. ron!": "moron", "1d iot": "idiot", "iid ioot": "idiot",
    }.items():
        for text in (disguised, f"The {disguised} was", f"the {disguised}, 7 \u0436\u0436 {disguised}."):
            assert meant in decoder.words(text), (text, decoder.words(text))
    assert {"letter", "look"} <= decoder.words("a letter, look") and decoder.joined(decoder.shaped("it is of the man".split())) == set()
    for word in ("iiddiioott", "letter", "aab", "baa", "aa", "ooffee", "stuuupid", "wwhheenn"):
        assert decoder.squeezed(word) == decoder.viterbi(word), word


def test_stretches_are_the_search_of_the_whole_text(decoder):
    rng = np.random.default_rng(0)
    pieces = "the st upid id iot i di ot a of and tra sh look oo 1d x| s scu m er los".split()
    for _ in range(300):
        tokens = [str(t) for t in rng.choice(pieces, rng.integers(2, 9))]
        dropped = [c == "\n" for c in decoder._path(" ".join(tokens)) if c in " \n"]
        shapes = decoder.shaped(tokens)
        runs = [tokens[:1]]
        for token, together in zip(tokens[1:], dropped, strict=True):
            runs[-1].append(token) if together else runs.append([token])
        assert decoder.joined(shapes) == {"".join(r) for r in runs if len(r) > 1}, tokens


def test_words_that_begin_like_no_feature_are_not_searched(decoder, monkeypatch):
    """What is found is the same as when every word is read."""
    searched, path = [], toxicity.Decoder._path
    monkeypatch.setattr(toxicity.Decoder, "_path", lambda self, text: searched.append(text) or path(self, text))
    rng, weight = np.random.default_rng(1), {"idi-": 1.0, "stupid": 1.0, "tra-": 1.0, "scum": 1.0}
    pieces = "harml3ss harm!less the 1diot idi0t st up1d iidiot stuppid5 tr4sh tras# sc\u00fc scu m. ###scum tra\u0436h \u00e9t3 id1 (idiot) x| of".split()
    texts = [" ".join(rng.choice(pieces, rng.integers(1, 9)).tolist()) for _ in range(300)]
    found = toxicity.Marks(toxicity.Decoder(decoder.cost), weight).of_texts(texts)
    assert "idi0t" in searched and not [t for t in searched if t.startswith("harm")]
    whole = toxicity.Decoder(decoder.cost)
    assert found == [{f for w in whole.words(t) for f in toxicity.beginnings(w) if f in weight} for t in texts]


def test_counts_follow_every_character(spark):
    docs = spark.createDataFrame([("Ab b",), (None,), ("",), ("a" * (1 << 20) + "bc",)], "text string")
    n = {r["trigram"]: r["n"] for r in toxicity.trigram_counts(docs).collect()}
    code = lambda *x: (x[0] * 64 + x[1]) * 64 + x[2]
    end = toxicity.END
    assert n[code(end, 0, 1)] == 1 and n[code(0, 1, end)] == 1 and n[code(end, 1, end)] == 1
    assert n[code(0, 0, 0)] == (1 << 20) - 2 and n[code(0, 1, 2)] == 1 and n[code(1, 2, end)] == 1


def test_disguise_does_not_help(spark):
    rows = []
    for k in range(400):
        bad = k % 4 == 0
        word = ("idiot", "moron")[k % 8 == 0] if bad else "wordy"
        rows.append((k, f"some text {chr(97 + k % 26)}bc {word} and more of it {chr(97 + k % 17)}de", int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    more = spark.createDataFrame([(1000, "some text 1d10t and"), (1001, "some m o r o n more"), (1002, "some wordy text")], "doc_id bigint, text string")
    scores = toxicity.toxicity_scores(docs.select("doc_id", "text").unionByName(more), docs.select("doc_id", "toxic"))
    got = {r.doc_id: r.score for r in scores.where("doc_id >= 1000").collect()}
    assert got[1000] > 0.7 and got[1001] > 0.7 and got[1002] < 0.5


RUSSIAN = "он сказал что этот идиот опять пришёл на работу и дурак не понял ничего а вот собака спит дома около окна"
GREEK = "αυτός ο ηλίθιος ήρθε πάλι στο σπίτι και ο βλάκας δεν κατάλαβε τίποτα από όλα αυτά"
CZECH = "ten hloupý žlutý kůň řekl že tvůj debil přišel zase pozdě a łódź płynie dalej przez żółte morze"
JAPANESE = "これ は 馬鹿 です また 今日 も 来た"


@pytest.fixture(scope="module")
def wide(spark):
    docs = spark.createDataFrame([(t,) for t in [RUSSIAN, GREEK, CZECH, JAPANESE] * 50] + [("the man was an idiot of the house and a moron at home",)] * 100, "text string")
    alphabet = toxicity.corpus_alphabet(docs)
    counts = np.zeros(alphabet.symbols**3, np.int64)
    for r in toxicity.trigram_counts(docs, alphabet).collect():
        counts[r["trigram"]] = r["n"]
    return toxicity.Decoder(toxicity.language_model(counts), alphabet)


def test_every_script_is_read_as_itself(wide):
    for text in (RUSSIAN, GREEK, CZECH, JAPANESE):
        longer = {w for w in text.split() if len(w) > 1 and not set(w) <= set(toxicity.ALIKE)}
        assert longer <= wide.words(text), longer - wide.words(text)
    assert {"moron", "the"} <= wide.words("the mоrоn")  # Cyrillic letters in a Latin word


def test_disguise_in_other_scripts_is_read(wide):
    for disguised, meant in {
        "иди0т": "идиот", "ииддииот": "идиот", "и д и о т": "идиот", "и-д-и-о-т": "идиот", "иди от": "идиот", "идиoт": "идиот", "дурaк": "дурак",
        "ηηλίθιος": "ηλίθιος", "β λ ά κ α ς": "βλάκας", "hl0upý": "hloupý", "žžlutý": "žlutý", "řř3kl": "řekl", "馬 馬鹿": "馬鹿",
    }.items():
        assert meant in wide.words(f"{disguised}"), (disguised, wide.words(disguised))


def test_rare_letters_share_a_symbol_and_stay_themselves(spark):
    many = "".join(chr(0x4E00 + k) for k in range(300))
    docs = spark.createDataFrame([(many,), (many[:100],), (None,), ("",)], "text string")
    alphabet = toxicity.corpus_alphabet(docs)
    assert alphabet.symbols == toxicity.MOST_SYMBOLS and sorted(alphabet.more) == sorted(many)
    n = {r["trigram"]: r["n"] for r in toxicity.trigram_counts(docs, alphabet).collect()}
    assert sum(n.values()) == 300 + 100 + 2  # a trigram ends in each letter and at each text's end; empty texts have none
    cost = toxicity.language_model(np.bincount(list(n), list(n.values()), alphabet.symbols**3))
    assert many in toxicity.Decoder(cost, alphabet).words(many)


def test_toxic_words_of_another_script_are_learnt_once_per_id(spark):
    rows = []
    for k in range(400):
        bad = k % 8 == 0
        rows.append((k, f"вот {chr(0x430 + k % 26)}бв {'идиот' if bad else 'хороший'} и ещё {chr(0x430 + k % 17)}де", int(bad)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    repeated = spark.range(300).selectExpr("CAST(1 AS BIGINT) AS doc_id", "'вот идиот' AS text")  # one id in many rows
    more = spark.createDataFrame([(1000, "вот иди0т и"), (1001, "вот и д и о т ещё"), (1002, "вот хороший и")], "doc_id bigint, text string")
    scores = toxicity.toxicity_scores(docs.select("doc_id", "text").unionByName(more).unionByName(repeated), docs.select("doc_id", "toxic"))
    got = {r.doc_id: r.score for r in scores.where("doc_id >= 1000").collect()}
    assert got[1000] > 0.7 and got[1001] > 0.7 and got[1002] < 0.5 and scores.count() == 703
