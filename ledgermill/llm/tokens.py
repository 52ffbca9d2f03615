"""Byte-level BPE encoding and decoding by the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import table

RANK_FILE = "byte_bpe_50k.tiktoken"
RANK_BYTES = 64 << 20
"""A larger rank file is refused, as its content is sent to all tasks."""
STRETCH = 1 << 15
"""Characters after which a text is cut at the next safe boundary; a stretch twice as long is encoded match by match."""
BATCH_BYTES = 16 << 20
"""Bytes of ids or text a task returns at a time."""

# Where the pattern's matches surely end and the next one starts, whatever stands around: before white space behind
# anything else, and where ASCII letters, digits and signs meet, but for a letter behind a sign (an apostrophe may take it).
_SIGN = r"!-/:-@\[-`{-~"
_SAFE = re.compile(rf"(?<=\S)(?=[ \t\n\r])|(?<=[A-Za-z])(?=[0-9{_SIGN}])|(?<=[0-9])(?=[A-Za-z{_SIGN}])")


def rank_table(path: str | Path) -> bytes:
    """The content of a rank file (a token in base 64 and its rank on each line) that holds every single byte."""
    content = Path(path).read_bytes()
    if len(content) > RANK_BYTES:
        raise ValueError(f"{path} takes {len(content)} bytes; {RANK_BYTES} are allowed")
    ranks = _ranks(content)
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"{path} has no rank for the bytes {missing}")
    if len(set(ranks.values())) < len(ranks):
        raise ValueError(f"{path} gives a rank twice")
    return content


def _ranks(content: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, content.splitlines()))}


@lru_cache(maxsize=4)
def _encoding(content: bytes, pattern: str) -> tiktoken.Encoding:
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=_ranks(content), special_tokens={})


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    """A text cut where matches of the pattern end anyway: pieces of ``size`` characters, or more up to the next such place."""
    at = 0
    while len(text) - at > size and (found := _SAFE.search(text, at + size)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def encode(encoding: tiktoken.Encoding, pattern: regex.Pattern, text: str, size: int = STRETCH) -> np.ndarray:
    """The token ids of one text.

    A stretch in which no safe place comes for long (one word, blank space or
    script without spaces) is taken match by match, as its matches may be
    longer than what the library's own search can go back over.
    """
    if len(text) <= size:
        return np.array(encoding.encode_ordinary(text), "<u4")
    ids: list[int] = []
    for piece in stretches(text, size):
        if len(piece) <= 2 * size:
            ids += encoding.encode_ordinary(piece)
        else:
            for match in pattern.finditer(piece):
                ids += encoding._encode_single_piece(match[0])
    return np.array(ids, "<u4")


def _slices(sizes: list[int]) -> Iterator[slice]:
    """Consecutive rows of about ``BATCH_BYTES`` together."""
    start, held = 0, 0
    for k, size in enumerate(sizes):
        held += size
        if held >= BATCH_BYTES:
            yield slice(start, k + 1)
            start, held = k + 1, 0
    if start < len(sizes):
        yield slice(start, len(sizes))


def encoded(docs: DataFrame, rank_file: str | Path, pattern: str = public_tokenizers.PATTERN, stretch: int = STRETCH) -> DataFrame:
    """``doc_id, ids`` for each row of ``docs(doc_id, text)``: token ids as little-endian unsigned 32-bit integers.

    Each match of ``pattern`` is encoded on its own by the ranks in
    ``rank_file``, a file the driver reads and sends to all tasks; there are
    no special tokens, so their strings are ordinary text. Rows stay where they
    are: no shuffle, and a task holds one batch.

    ``pattern`` must be one for which the safe boundaries hold: no match goes
    on over white space or from ASCII letters or digits into another class of
    ASCII, as with the public patterns of byte-level BPE.

    A null or empty text has no ids (an empty binary value); null ids, ties and
    repeated rows are encoded like any other; an empty table gives no rows.
    Other columns are ignored.
    """
    rows = docs.select("doc_id", "text")
    sent = docs.sparkSession.sparkContext.broadcast((rank_table(rank_file), pattern))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, matches = _encoding(*sent.value), regex.compile(sent.value[1])
        for batch in batches:
            ids, held, start = [], 0, 0
            for at, text in enumerate(batch.column("text")):
                ids.append(encode(encoding, matches, text.as_py() or "", stretch).tobytes())
                held += len(ids[-1])
                if held >= BATCH_BYTES or at + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(ids)), pa.array(ids, pa.binary())], ["doc_id", "ids"])
                    ids, held, start = [], 0, at + 1

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary")


def decoded(tokens: DataFrame, rank_file: str | Path) -> DataFrame:
    """``doc_id, ids, content`` for each row of ``tokens(doc_id, ids)``: the bytes the ids stand for.

    ``ids`` are as :func:`encoded` gives them. The content is raw bytes: ids
    cut off in the middle of a character give the bytes they have, where text
    would need a replacement. Null ids are no content (an empty binary value);
    an id without a token or a broken length is an error. Other columns are ignored.
    """
    rows = tokens.select("doc_id", "ids")
    sent = tokens.sparkSession.sparkContext.broadcast(rank_table(rank_file))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(sent.value, public_tokenizers.PATTERN)
        for batch in batches:
            ids = [np.frombuffer(x.as_py() or b"", "<u4") for x in batch.column("ids")]
            for part in _slices([8 * len(x) for x in ids]):
                content = pa.array([encoding.decode_bytes(x.tolist()) for x in ids[part]], pa.binary())
                rows = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*rows.columns, content], ["doc_id", "ids", "content"])

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, content binary")


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tokens each document has, and digests of its ids and of what they decode to."""
    ranks = public_tokenizers.path(RANK_FILE)
    found = decoded(encoded(table(spark, sf_dir, "documents"), ranks), ranks)
    return found.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("content", 256).alias("decoded_sha256"),
    )
