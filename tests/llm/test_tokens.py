"""Byte-level BPE against merges done by hand, the library on whole texts, and round trips."""

import hashlib
import struct

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgermill.llm import tokens
from ledgermill.llm.common import table

PATH = public_tokenizers.path(tokens.RANK_FILE)
RANKS = tokens._ranks(tokens.rank_table(PATH))
WHOLE = tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PATTERN = regex.compile(public_tokenizers.PATTERN)


def by_hand(text):
    """Each match on its own: the pair with the smallest rank, leftmost first, until none is left."""
    out = []
    for match in PATTERN.finditer(text):
        parts = [bytes([b]) for b in match[0].encode()]
        while pairs := [(RANKS[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in RANKS]:
            k = min(pairs)[1]
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        out += [RANKS[p] for p in parts]
    return out


def rows(spark, texts, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = tokens.decoded(tokens.encoded(docs, PATH, **more), PATH)
    return {r.doc_id: (np.frombuffer(r.ids, "<u4").tolist(), bytes(r.content)) for r in found.collect()}


TEXTS = [
    "Hello world's 'tis we'll  don't\n\n  x", "<|endoftext|> 12345a6 a1-b2", "naïve Ünïcödé żółw идиот 你好，世界 🙂👍🏽", "\x00\x1c\x85 　 end ",
    "''s'll 'l5 're've", None, "",
]


def test_ids_are_those_of_merges_by_hand(spark):
    for size in (2, 7, tokens.STRETCH):
        found = rows(spark, TEXTS, stretch=size)
        for k, text in enumerate(TEXTS):
            assert found[k] == (by_hand(text or ""), (text or "").encode()), (size, text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab'sltvred 19\n\t-.,é你\x1c　🙂"), max_size=60), st.integers(1, 9))
def test_cuts_change_nothing(text, size):
    assert "".join(tokens.stretches(text, size)) == text
    assert tokens.encode(WHOLE, PATTERN, text, size).tolist() == WHOLE.encode_ordinary(text)


def test_long_texts(spark):
    texts = ["word " * 60_000, "x" + " " * 2_500_000 + "y", "a" * 300_000, "你好" * 100_000, "aB3+/" * 80_000, "\n" * 200_000 + "x"]
    found = rows(spark, texts)
    for k, text in enumerate(texts):
        ids, content = found[k]
        assert content == text.encode()
        # the library can't go back over so many blanks at once; the last of them belongs to the letter
        want = [*WHOLE._encode_single_piece("x"), *WHOLE._encode_single_piece(" " * 2_499_999), *WHOLE._encode_single_piece(" y")] if k == 1 else WHOLE.encode_ordinary(text)
        assert ids == want


def test_ids_cut_inside_a_character_decode_to_bytes(spark):
    ids = WHOLE.encode_ordinary("🙂")
    assert len(ids) > 1
    packed = spark.createDataFrame([(1, struct.pack("<I", ids[0])), (2, None)], "doc_id bigint, ids binary")
    found = {r.doc_id: bytes(r.content) for r in tokens.decoded(packed, PATH).collect()}
    assert found == {1: WHOLE.decode_single_token_bytes(ids[0]), 2: b""}


def test_query_is_the_library_s(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in tokens.op11_byte_bpe(spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    assert len(found) == len(docs)
    for r in docs:
        ids = WHOLE.encode_ordinary(r.text or "")
        got = found[r.doc_id]
        assert (got.n_tokens, got.ids_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest())
        assert got.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_odd_rows(spark, odd_docs, no_docs):
    found = tokens.decoded(tokens.encoded(odd_docs, PATH), PATH).collect()
    want = sorted(((r.doc_id or 0), (r.text or "").encode()) for r in odd_docs.collect())
    assert sorted(((r.doc_id or 0), bytes(r.content)) for r in found) == want
    assert tokens.encoded(no_docs, PATH).collect() == []


def test_faulty_rank_files(tmp_path):
    (tmp_path / "few").write_text("YQ== 0\n")
    with pytest.raises(ValueError, match="no rank"):
        tokens.rank_table(tmp_path / "few")
    (tmp_path / "twice").write_bytes(tokens.rank_table(PATH) + b"YWFhYWFhYWFhYWFhYWFh 0\n")
    with pytest.raises(ValueError, match="twice"):
        tokens.rank_table(tmp_path / "twice")
