"""SimHash near-duplicates by one-wildcard segment signatures."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgermill.llm.common import carried, components, table, written

# Fixed values of the fingerprint.
BITS = 64
SEED = 42
SHINGLE = 3
DISTANCE = 2

SEGMENT = BITS // 2
"""Two differing bits over two segments: one segment has at most one of them."""
HOT = 512
"""Above so many fingerprints in one bucket they are linked by wildcard pairs, which never meet all at once."""


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles as a signed 64-bit number; 0 without words.

    A-Z are lower-cased; words are split at ASCII white space; a text of fewer
    words than a shingle is one shingle. A bit is set if it is in over half of
    the shingles' hashes, repeats included.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        hashes = [xxhash.xxh64_intdigest(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(shingle)), strict=False)]
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):  # a long text is summed in pieces
        piece = np.array(hashes[at : at + (1 << 16)], dtype="<u8")
        counts += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, row, text_hash, fp`` for each row: what tells rows apart, and the fingerprint as a bigint."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.as_py(), shingle) for text in batch.column("text")]
            kept = [batch.column(c) for c in ("doc_id", "row", "text_hash")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.int64())], ["doc_id", "row", "text_hash", "fp"])

    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row"), F.xxhash64("text").alias("text_hash"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(prints, f"doc_id {id_type}, row bigint, text_hash bigint, fp bigint")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _number(which: int, segment: Column) -> Column:
    """The segment's 32 bits below the number of the segment and wildcard, in one bigint."""
    low = F.shiftrightunsigned(segment, SEGMENT) if _upper(which) else segment
    return low.bitwiseOR(F.lit(which << SEGMENT))


def _upper(which: int) -> bool:
    """Whether signature ``which`` is of the upper segment: 0 and 1 are the whole ones, 2 + b has bit b as its wildcard."""
    return which == 1 or which >= 2 + SEGMENT


def _signatures(fp: Column) -> Column:
    """All keys a fingerprint is indexed under: each segment, and each segment with one of its bits as a wildcard."""
    lower = (1 << SEGMENT) - 1
    keys = []
    for which in range(2 + BITS):
        mask = lower << SEGMENT if _upper(which) else lower
        if which >= 2:
            mask &= ~(1 << (which - 2))
        keys.append(_number(which, fp.bitwiseAND(F.lit(_signed(mask)))))
    return F.array(*keys)


def _wildcard_pairs(spark: SparkSession) -> DataFrame:
    """For each signature the pairs of wildcards that find its bucket's links: a table of fixed size.

    A bucket of equal segments leaves two wildcards to the other segment; one
    of segments that differ in a bit leaves one there.
    """
    rows = []
    for which in range(2 + BITS):
        other = range(SEGMENT) if _upper(which) else range(SEGMENT, BITS)
        pairs = combinations(other, 2) if which < 2 else ((which - 2, o) for o in other)
        for a, b in pairs:
            rows.append((which, min(a, b) * BITS + max(a, b), _signed(~((1 << a) | (1 << b)) % (1 << BITS))))
    return spark.createDataFrame(rows, "which int, pair int, mask bigint")


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct ``prints(fp)`` within ``distance`` (at most 2) bits.

    One-wildcard signatures of two segments are joined on equality and every
    pair is verified; buckets of one member are dropped by a count first.
    Fingerprints of a bucket with more than ``HOT`` members (near copies by the
    thousand) are linked through keys with two wildcards instead, whose groups
    hold four at most: so work grows with the number of fingerprints, not with
    its square, and no link is lost.
    """
    if not 0 <= distance <= 2:
        raise ValueError("two segments with one wildcard find pairs within two bits")
    entries = prints.select("fp", F.explode(_signatures(F.col("fp"))).alias("key"))
    shared = written(entries.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"))
    which = F.shiftright("key", SEGMENT).cast("int").alias("which")
    # shuffled at every size: whether few keys are shared says nothing about the next table
    met = written(entries.join(shared.hint("merge"), "key").select("fp", "key", which, (F.col("members") > HOT).alias("hot")))
    small = met.where(~F.col("hot"))
    left, right = small.select("key", "which", F.col("fp").alias("a")), small.select("key", F.col("fp").alias("b"))
    # under a wildcard only those meet that differ in its bit; the others meet under the whole segment
    differ = F.expr("shiftright(a ^ b, which - 2) & 1 = 1")
    apart = (F.col("a") < F.col("b")) & ((F.col("which") < 2) | differ)
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    edges = left.join(right, "key").where(apart & near).select("a", "b")
    keyed = met.where("hot").join(F.broadcast(_wildcard_pairs(prints.sparkSession)), "which")
    few = keyed.select("pair", F.col("fp").bitwiseAND(F.col("mask")).alias("rest"), "fp").groupBy("pair", "rest").agg(
        F.collect_set("fp").alias("fps")
    )
    pairs = few.where(F.size("fps") > 1).select("fps", F.explode("fps").alias("a")).select("a", F.explode("fps").alias("b"))
    return edges.unionByName(pairs.where((F.col("a") < F.col("b")) & near))


def _grouped(docs: DataFrame, shingle: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """Each row's fingerprint, and each fingerprint's component and first row."""
    prints = written(fingerprints(docs, shingle))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "text_hash"))
    nodes = written(prints.groupBy("fp").agg(first.alias("first")))
    groups = components(links(nodes.select("fp"), distance))
    named = nodes.join(groups, nodes["fp"] == groups["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    return prints, written(named)


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``doc_id, fp, component_id``: each row of ``docs(doc_id, text)`` with its group's smallest id.

    Documents link if their fingerprints differ in at most ``distance`` bits;
    a group is what links reach. Equal fingerprints are one node, so copies are
    never paired.

    A null text or one without words has fingerprint 0, which links like any
    other; null ids are ignored in a group's smallest id (null if it has no
    other); repeated rows are all returned; an empty table gives no rows.
    Columns other than those named are ignored.
    """
    prints, named = _grouped(docs, shingle, distance)
    smallest = named.groupBy("component").agg(F.min("first")["doc_id"].alias("component_id"))
    of_print = named.join(smallest, "component").select("fp", "component_id")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One row of each group of near duplicates in ``docs``, the one with the smallest id; all columns stay.

    A row without an id stays only where its whole group has none; of rows
    equal in id and text one stays.
    """
    _, named = _grouped(docs, shingle, distance)
    kept = named.groupBy("component").agg(F.min("first").alias("first")).select(
        "first.row", "first.text_hash"
    )
    same = Window.partitionBy("row", "text_hash").orderBy(F.lit(0))
    one = carried(docs).join(kept, ["row", "text_hash"], "left_semi").withColumn("nth", F.row_number().over(same))
    return one.where("nth = 1").select("doc.*")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
