"""Removal of passages that repeat word for word, by fixed-block anchors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import table

WINDOW = 13
"""A passage counts as repeated from so many consecutive words on."""
CHUNK = 1 << 20
"""Words a task holds as numbers at a time; a longer document is held alone."""
PART_BYTES = 24 << 20
"""Text bytes whose windows (about one for 6 bytes) are compared in one task."""
NO_ID = (1 << 63) - 1


def block_words(window: int) -> int:
    """The longest block that every window surely holds a whole one of, wherever blocks start."""
    return (window + 1) // 2


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))


def rolling(hashes: np.ndarray, width: int, seed: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """A hash of every ``width`` consecutive words, in the order of their starts."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(n, np.uint64)
        for k in range(width):
            out = out * np.uint64(seed | 1) + hashes[k : k + n]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(29)
    return out


def _second(hashes: np.ndarray, width: int) -> np.ndarray:
    """32 further bits, so that two windows agree by chance once in 2^96."""
    with np.errstate(over="ignore"):
        other = (hashes ^ (hashes >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (rolling(other, width, 0x165667B19E3779F9) >> np.uint64(32)).astype(np.uint32)


def _by_document(part: int, kind: int, ids: np.ndarray, values: np.ndarray) -> dict:
    """One shuffled row: values of many documents, each document's side by side."""
    order = np.argsort(ids, kind="stable")
    own, counts = np.unique(ids, return_counts=True)
    return {
        "part": part,
        "kind": kind,
        "ids": own.astype("<i8").tobytes(),
        "counts": counts.astype("<u4").tobytes(),
        "values": np.ascontiguousarray(values[order]).tobytes(),
    }


SHUFFLED = "part int, kind int, ids binary, counts binary, values binary"
"""Values by the partition that compares them; on their way back, by the documents' bucket (``kind`` is then the partition)."""


def _read(group: pa.Table, kind: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and value (as raw bytes) of every entry of one kind."""
    ids, values = [], []
    for k, own, counts, raw in zip(*(group.column(c).to_pylist() for c in ("kind", "ids", "counts", "values")), strict=True):
        if k == kind:
            ids.append(np.repeat(np.frombuffer(own, "<i8"), np.frombuffer(counts, "<u4")))
            values.append(np.frombuffer(raw, np.uint8).reshape(-1, width))
    if not ids:
        return np.empty(0, np.int64), np.empty((0, width), np.uint8)
    return np.concatenate(ids), np.concatenate(values)


def bucket_of(ids: np.ndarray, buckets: int) -> np.ndarray:
    """What ``pmod(xxhash64(key), buckets)`` is for each id."""
    own, back = np.unique(ids, return_inverse=True)
    hashed = np.fromiter((xxhash.xxh64_intdigest(int(i).to_bytes(8, "little", signed=True), 42) for i in own), np.uint64, len(own))
    return np.mod(hashed.view(np.int64), buckets)[back]


def _returned(part: int, buckets: int, ids: np.ndarray, values: np.ndarray) -> pa.Table:
    """A partition's findings, packed by the bucket of the documents they are for."""
    bucket = bucket_of(ids, buckets)
    rows = [_by_document(int(b), part, ids[bucket == b], values[bucket == b]) for b in np.unique(bucket)]
    return _tables(rows, _SHUFFLED)


class Findings:
    """What partitions found for the documents of one bucket."""

    def __init__(self, packed: pa.Table, width: int):
        ids, values, parts = [], [], []
        for part, own, counts, raw in zip(*(packed.column(c).to_pylist() for c in ("kind", "ids", "counts", "values")), strict=True):
            ids.append(np.repeat(np.frombuffer(own, "<i8"), np.frombuffer(counts, "<u4")))
            values.append(_eight(np.frombuffer(raw, np.uint8).reshape(-1, width)))
            parts.append(np.full(len(ids[-1]), part, np.uint64))
        every = np.concatenate(ids) if ids else np.empty(0, np.int64)
        order = np.argsort(every, kind="stable")
        self.ids = every[order]
        self.values = np.concatenate(values)[order] if ids else np.empty(0, np.uint64)
        self.parts = np.concatenate(parts)[order] if ids else np.empty(0, np.uint64)

    def of(self, key: int) -> slice:
        return slice(int(np.searchsorted(self.ids, key, "left")), int(np.searchsorted(self.ids, key, "right")))


def _anchors(h: np.ndarray) -> np.ndarray:
    """The upper 32 bits, the lowest of them 0; that bit will say whether any is a block.

    Within a partition, whose size is bounded, four bytes tell anchors apart
    well enough: one in some thousand hits is by chance, and costs no more than
    a comparison of whole windows.
    """
    return (h >> np.uint64(32)) & ~np.uint64(1)


def _four(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :4]


def _eight(raw: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, : raw.shape[1]] = raw
    return wide.view("<u8").reshape(-1)


_SHUFFLED = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("ids", pa.binary()), ("counts", pa.binary()), ("values", pa.binary())])


def _tables(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


def _chunks(found: Iterator[tuple]) -> Iterator[list[tuple]]:
    """Lists of a document's ``(key, hashes, ...)`` of at most ``CHUNK`` hashes together."""
    held, words = [], 0
    for one in found:
        if words and words + len(one[1]) > CHUNK:
            yield held
            held, words = [], 0
        held.append(one)
        words += len(one[1])
    if held:
        yield held


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    for batch in batches:
        for key, text in zip(batch.column("key"), batch.column("text"), strict=True):
            yield key.as_py(), (text.as_py() or "").encode().split()


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the runs of equal values in sorted ``keys``."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, np.int64)
    return starts, np.diff(np.r_[starts, len(keys)])


def _probe(parts: int, block: int):
    """Rolling windows of all documents, and which of them are index blocks, by partition of their hash.

    Windows that several documents of a chunk share are hits already (kind 1);
    only their first document stands for them (kind 0), so a passage in a third
    of all documents is one entry per chunk and not one per document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _chunks((key, rolling(word_hashes(words), block)) for key, words in _texts(batches)):
            h = np.concatenate([x[1] for x in held])
            ids = np.repeat(np.array([x[0] for x in held], np.int64), [len(x[1]) for x in held])
            is_block = np.concatenate([np.arange(len(x[1])) % block == 0 for x in held])
            part = (h % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((ids, h, part))
            h, ids, is_block, part = h[order], ids[order], is_block[order], part[order]
            starts, sizes = _groups(h)
            if not len(starts):
                continue
            several = ids[starts] != ids[starts + sizes - 1]
            blocks = np.logical_or.reduceat(is_block, starts)
            anchors = _four(_anchors(h[starts]) | blocks.astype(np.uint64))
            rows = []
            for p in np.unique(part[starts]):
                mine = part[starts] == p
                rows.append(_by_document(int(p), 0, ids[starts][mine], anchors[mine]))
            inside = np.repeat(several, sizes)
            once = inside & np.r_[True, (h[1:] != h[:-1]) | (ids[1:] != ids[:-1])]
            for p in np.unique(part[once]):
                mine = once & (part == p)
                rows.append(_by_document(int(p), 1, ids[mine], _four(_anchors(h[mine]))))
            yield from _tables(rows, _SHUFFLED).to_batches()

    return run


def _hits(buckets: int):
    """Anchors that are a block in one place and occur in another document."""

    def run(group: pa.Table) -> pa.Table:
        ids, raw = _read(group, 0, 4)
        values = _eight(raw)
        order = np.argsort(values >> np.uint64(1), kind="stable")
        ids, values = ids[order], values[order]
        starts, sizes = _groups(values >> np.uint64(1))
        known_ids, known = _read(group, 1, 4)
        if len(starts):
            hit = np.repeat((sizes > 1) & (np.bitwise_or.reduceat(values & np.uint64(1), starts) > 0), sizes)
            known_ids = np.concatenate([known_ids, ids[hit]])
            known = np.concatenate([known, _four(values[hit] & ~np.uint64(1))])
        return _returned(group.column("part")[0].as_py(), buckets, known_ids, known)

    return run


def _extend(parts: int, block: int, window: int):
    """Every window around a hit, by partition of its hash; the smallest document of a chunk stands for it."""

    def near(docs: pa.Table, hits: Findings) -> Iterator[tuple]:
        found = hits.values * np.uint64(parts) + hits.parts
        for key, words in _texts(docs.to_batches()):
            mine = hits.of(key)
            if mine.start == mine.stop:
                continue
            hashes = word_hashes(words)
            h = rolling(hashes, block)
            at = np.isin(_anchors(h) * np.uint64(parts) + h % np.uint64(parts), found[mine])
            whole, seen, span = rolling(hashes, window), np.r_[0, np.cumsum(at)], window - block + 1
            close = seen[span : span + len(whole)] > seen[: len(whole)]
            yield key, whole[close], _second(hashes, window)[close]

    def run(docs: pa.Table, packed: pa.Table) -> pa.Table:
        rows: list[dict] = []
        for held in _chunks(near(docs, Findings(packed, 4))):
            h, more = np.concatenate([x[1] for x in held]), np.concatenate([x[2] for x in held])
            ids = np.repeat(np.array([x[0] for x in held], np.int64), [len(x[1]) for x in held])
            order = np.lexsort((ids, more, h))
            h, more, ids = h[order], more[order], ids[order]
            if not len(h):
                continue
            new = np.r_[True, (h[1:] != h[:-1]) | (more[1:] != more[:-1])]
            once = new | np.r_[True, ids[1:] != ids[:-1]]
            least = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
            part = (h % np.uint64(parts)).astype(np.int64)
            raw = np.concatenate([h.astype("<u8").view(np.uint8).reshape(-1, 8), more.astype("<u4").view(np.uint8).reshape(-1, 4)], axis=1)
            for kind, chosen in ((0, new), (1, once & (ids > least))):
                for p in np.unique(part[chosen]):
                    mine = chosen & (part == p)
                    rows.append(_by_document(int(p), kind, ids[mine], raw[mine]))
        return _tables(rows, _SHUFFLED)

    return run


def _later(buckets: int):
    """Windows that also start in a document with a smaller id."""

    def run(group: pa.Table) -> pa.Table:
        ids, raw = _read(group, 0, 12)
        h, more = _eight(raw[:, :8]), _eight(raw[:, 8:])
        order = np.lexsort((ids, more, h))
        ids, h, more = ids[order], h[order], more[order]
        new = np.r_[True, (h[1:] != h[:-1]) | (more[1:] != more[:-1])] if len(h) else np.empty(0, bool)
        later = ids > ids[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else new
        known_ids, known = _read(group, 1, 12)
        values = np.concatenate([known[:, :8], h[later].astype("<u8").view(np.uint8).reshape(-1, 8)])
        return _returned(group.column("part")[0].as_py(), buckets, np.concatenate([known_ids, ids[later]]), values)

    return run


def covered(words: list[bytes], removed: np.ndarray, window: int) -> np.ndarray:
    """Which words the windows with the given hashes cover, overlaps merged into maximal stretches."""
    out = np.zeros(len(words) + 1, np.int64)
    if len(removed):
        at = np.flatnonzero(np.isin(rolling(word_hashes(words), window), removed))
        np.add.at(out, at, 1)
        np.add.at(out, at + window, -1)
    return np.cumsum(out[:-1]) > 0


_KEPT = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _cut(window: int):
    def run(docs: pa.Table, packed: pa.Table) -> pa.Table:
        removed, rows = Findings(packed, 8), []
        for key, words in _texts(docs.to_batches()):
            gone = covered(words, removed.values[removed.of(key)], window)
            kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g).decode()
            rows.append((key, len(words), int(gone.sum()), kept))
        return pa.Table.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_KEPT)], schema=_KEPT)

    return run


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for each row of ``docs(doc_id, text)``.

    A word goes if a window of ``window`` consecutive words that covers it also
    starts in a document with a smaller id; ``kept`` joins the others by single
    spaces. Windows are judged on the input.

    Blocks of ``block_words(window)`` words at every such multiple are the
    index; every window holds a whole one. All rolling windows of that width
    probe it by equality of hashes. Around each hit the windows are compared
    whole (96 bits of hash), so hits grow to maximal repeats. Values travel
    packed: to the task that compares those of about ``PART_BYTES`` of text,
    and back to the documents' bucket of that size; a passage common to many
    documents counts once per chunk of a task.

    Words are split at ASCII white space and compared unchanged. A null text
    has no words; a null id counts as larger than all; rows that share an id
    are one document for the comparison and never remove each other's words;
    an empty table gives no rows. Other columns are ignored.
    """
    block = block_words(window)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(size / PART_BYTES))
    key = F.coalesce("doc_id", F.lit(NO_ID)).cast("bigint")
    rows = docs.select(F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part"), key.alias("key"), "text")
    found = rows.select("key", "text").mapInArrow(_probe(parts, block), SHUFFLED)
    hits = found.groupBy("part").applyInArrow(_hits(parts), SHUFFLED)
    # both meetings shuffle the same rows, so the texts move once
    near = rows.groupBy("part").cogroup(hits.groupBy("part")).applyInArrow(_extend(parts, block, window), SHUFFLED)
    later = near.groupBy("part").applyInArrow(_later(parts), SHUFFLED)
    cut = rows.groupBy("part").cogroup(later.groupBy("part")).applyInArrow(
        _cut(window), "key bigint, n_words bigint, n_removed bigint, kept string"
    )
    return cut.select(F.when(F.col("key") != NO_ID, F.col("key")).alias("doc_id"), "n_words", "n_removed", "kept")


def _sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document repeat an earlier one, and the digest of what stays."""
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", _sha256(F.col("kept")).alias("kept_sha256"))


OP7_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, p, sha256(array_to_string(list_slice(w, p, p + 12), ' ')) AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d)
),
least AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT doc_id, list(p ORDER BY p) AS ps FROM win JOIN least USING (s) WHERE m < doc_id GROUP BY doc_id),
cover AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS q FROM (SELECT doc_id, unnest(ps) AS p FROM gone)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY q) AS text, count(*) AS n
  FROM words ANTI JOIN cover USING (doc_id, q) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
