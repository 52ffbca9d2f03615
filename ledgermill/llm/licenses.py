"""License scans: phrases word by word, and notices by an exact set-similarity join."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.llm.common import ascii_lower, table, written

# What a word is here, and the phrases that always count.
TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Common license notices and the labels the similarity join gives them.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "this work is licensed under a creative commons attribution 4 0 international license": "creative-commons",
    "this work is licensed under the gnu general public license version 3": "gpl",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}

THRESHOLD = 0.8
VOCABULARY = 20_000
"""Most distinct tokens the templates may have; they are constants of the plan and one small broadcast."""


CELL = 4
"""Words a cell has; blocks are made of whole cells."""


def needed(tokens: int, threshold: float) -> int:
    return math.ceil(threshold * tokens - 1e-9)


def tokens_of(template: str) -> list[str]:
    """Words of a notice as the texts' words are taken: A-Z lower-cased, repeats included."""
    lower = re.sub("[A-Z]", lambda letter: letter[0].lower(), template)
    return re.findall(TOKEN, lower)


def stride_of(words: int) -> int:
    """Words between the starts of the blocks for a notice of so many words: a power of two, at least ``CELL``."""
    return max(CELL, 1 << (words - 1).bit_length())


def words_of(lower: Column) -> Column:
    return F.regexp_extract_all(lower, F.lit(TOKEN), F.lit(0))


def _stands(words: Column, at: Column, phrase: str) -> Column:
    here = (F.get(words, at + k) == w for k, w in enumerate(phrase.split()))
    return F.coalesce(reduce(lambda a, b: a & b, here), F.lit(False))


def _places(words: Column, phrase: str) -> Column:
    """Starts of a phrase among the words; only texts that hold its rarest-looking word are walked."""
    none = F.array().cast("array<int>")
    holds = reduce(lambda a, b: a & b, (F.array_contains(words, w) for w in phrase.split()))
    starts = F.filter(F.sequence(F.lit(0), F.size(words) - 1), lambda at: _stands(words, at, phrase))
    return F.when(holds, starts).otherwise(none)


def _texts(values: list[str]) -> Column:
    return F.array(*(F.lit(v) for v in values)) if values else F.array().cast("array<string>")


def _measured(docs: DataFrame, vocabulary: list[str], phrases: Mapping[str, str]) -> DataFrame:
    """One pass over the texts: counts, phrase places, and the template words of each cell of ``CELL`` words."""
    words = F.col("_words")
    rows = docs.select("doc_id", words_of(ascii_lower(F.coalesce("text", F.lit("")))).alias("_words"))
    places = {p: _places(words, p) for p in phrases}
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(1), F.size(words), F.lit(CELL))).otherwise(F.array().cast("array<int>"))
    cells = F.transform(starts, lambda at: F.filter(F.slice(words, at, CELL), lambda w: w.isin(vocabulary)))
    return rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.size(words).cast("bigint").alias("n_words"),
        F.array_sort(F.flatten(F.array(*places.values()))).alias("places"),
        F.array_distinct(F.filter(F.array(*(F.when(F.size(a) > 0, F.lit(phrases[p])) for p, a in places.items())), F.isnotnull)).alias("base"),
        cells.alias("cells"),
    )


def _blocks(cells: Column, stride: int, prefix: list[str]) -> Column:
    """Blocks of two strides, one every stride, that hold a word of ``prefix``: an array of where, size and tokens."""
    starts = F.when(F.size(cells) > 0, F.sequence(F.lit(0), F.size(cells) - 1, F.lit(stride // CELL))).otherwise(F.array().cast("array<int>"))
    held = lambda at: F.flatten(F.slice(cells, at + 1, 2 * stride // CELL))
    blocks = F.transform(
        starts,
        lambda at: F.struct((at.cast("bigint") * CELL).alias("first_word"), F.lit(stride).alias("stride"), held(at).alias("tokens")),
    )
    return F.filter(blocks, lambda block: F.exists(block["tokens"], lambda w: w.isin(prefix)))


def _matches(measured: DataFrame, templates: Mapping[str, str], threshold: float) -> DataFrame:
    """``row, doc_id, first_word, stride, label, containment`` of every block that holds enough of a template's tokens.

    A template of at most ``stride`` words is looked for in blocks of twice as
    many, one every ``stride`` words, so that wherever it stands, also over line
    breaks, one block holds it whole. Tokens are ordered by how often the texts
    hold them, rarest first. Of a template only so many of its rarest tokens are
    indexed that a block without any of them can't hold enough (prefix filter);
    a block with fewer template words than needed is left out (length filter);
    and so is one whose tokens behind the matched one, on either side, can't
    make up the rest (positional filter). What is left is counted exactly.
    """
    spark = measured.sparkSession
    words = {t: tokens_of(t) for t in templates}
    sets = {t: sorted(set(found)) for t, found in words.items()}
    vocabulary = sorted({w for tokens in sets.values() for w in tokens})
    held = measured.select(F.explode(F.flatten("cells")).alias("token")).groupBy("token").count()
    counts = dict(held.collect())  # at most VOCABULARY rows
    order = {w: k for k, w in enumerate(sorted(vocabulary, key=lambda w: (counts.get(w, 0), w)))}
    index = []
    for t, tokens in sets.items():
        ranked, least = sorted(tokens, key=order.__getitem__), needed(len(tokens), threshold)
        for k, w in enumerate(ranked[: len(ranked) - least + 1]):
            index.append((w, templates[t], stride_of(len(words[t])), ranked, k, least))
    schema = "token string, label string, stride int, ranked array<string>, at int, least int"
    prefixes: dict[int, list[str]] = {}
    for w, _, stride, *_ in index:
        prefixes.setdefault(stride, []).append(w)
    candidates = F.concat(*(_blocks(F.col("cells"), stride, sorted(set(prefix))) for stride, prefix in sorted(prefixes.items())))
    blocks = measured.select("row", "doc_id", F.inline(candidates))
    everywhere = sorted({i[0] for i in index}, key=order.__getitem__)
    ranked_tokens = F.array_intersect(_texts(sorted(vocabulary, key=order.__getitem__)), F.col("tokens"))
    probes = blocks.select(
        "row", "doc_id", "first_word", "stride", F.size("tokens").alias("held"), ranked_tokens.alias("ranked_tokens")
    ).withColumn("token", F.explode(F.array_intersect(_texts(everywhere), F.col("ranked_tokens"))))
    behind = F.size("ranked_tokens") - F.array_position("ranked_tokens", F.col("token"))
    found = (
        probes.join(F.broadcast(spark.createDataFrame(index, schema)), ["token", "stride"])
        .where(F.col("held") >= F.col("least"))
        .where(1 + F.least(F.size("ranked") - F.col("at") - 1, behind) >= F.col("least"))
    )
    common = F.size(F.array_intersect("ranked", "ranked_tokens"))
    return found.where(common >= F.col("least")).select(
        "row", "doc_id", "first_word", "stride", "label", (common / F.size("ranked")).alias("containment")
    )


def _checked(templates: Mapping[str, str]) -> list[str]:
    words = {t: tokens_of(t) for t in templates}
    if not words or not all(words.values()):
        raise ValueError("a template has no tokens" if words else "there are no templates")
    vocabulary = sorted({w for found in words.values() for w in found})
    if len(vocabulary) > VOCABULARY:
        raise ValueError(f"templates have {len(vocabulary)} tokens, over {VOCABULARY}")
    return vocabulary


def notices(rows: DataFrame) -> dict[str, str]:
    """Templates of a table ``rows(text, label)`` of whole notices, as the scans take them.

    Rows without a word or a label are left out; of one text with several labels
    the smallest stays. Raises ValueError for over ``VOCABULARY`` rows, as each
    has a token at least that tells it apart or repeats another's.
    """
    kept = rows.where(F.col("label").isNotNull() & (F.size(words_of(ascii_lower(F.col("text")))) > 0))
    found = kept.groupBy("text").agg(F.min("label").alias("label")).limit(VOCABULARY + 1).collect()
    if len(found) > VOCABULARY:
        raise ValueError(f"over {VOCABULARY} notices")
    return {row.text: row.label for row in found}


def license_blocks(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, first_word, n_words, label, containment``: every block that holds enough of a notice, once per label.

    Blocks are stretches of ``n_words`` words from ``first_word`` (from 0; the
    last ones of a text are cut at its end); see ``_matches`` for their sizes.
    They overlap, so a notice may be found in two of them. ``containment`` is
    the best share of a template's distinct tokens that the block holds. Nulls,
    empty texts and empty tables have no such block; repeated rows repeat; other
    columns are ignored.
    """
    measured = written(_measured(docs, _checked(templates), PHRASES))
    found = _matches(measured, templates, threshold)
    best = found.groupBy("row", "doc_id", "first_word", "stride", "label").agg(F.max("containment").alias("containment"))
    return best.select("doc_id", "first_word", (2 * F.col("stride")).cast("bigint").alias("n_words"), "label", "containment")


def license_scan(
    docs: DataFrame,
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """License signs of each row of ``docs(doc_id, text)``.

    Returns ``doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score``. A-Z are lower-cased; base labels come from places where a
    phrase's words stand side by side; further ones from blocks of words, over
    line breaks too, that hold at least ``threshold`` of a notice's distinct
    tokens (``templates`` maps whole notices to labels). ``score`` is 1 with a
    base label, else the best such share, else 0.

    A null text counts as empty: no words, no labels (empty strings), score 0
    and null places. Rows are neither merged nor dropped, whatever their ids;
    an empty table gives no rows. Other columns are ignored.
    """
    measured = written(_measured(docs, _checked(templates), phrases))
    found = _matches(measured, templates, threshold)
    per_row = found.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    none = F.array().cast("array<string>")
    joined = measured.drop("cells").join(per_row, "row", "left")
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    return joined.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min("places").cast("bigint").alias("first_word"),
        F.array_max("places").cast("bigint").alias("last_word"),
        listed(F.col("base")).alias("base_labels"),
        listed(F.concat("base", F.coalesce("more", none))).alias("labels"),
        F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).cast(T.DoubleType()).alias("score"),
    )


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License signs of every document."""
    return license_scan(table(spark, sf_dir, "documents"))


_T = ",\n    ".join(f"('{t}', '{label}', {stride_of(len(tokens_of(t)))})" for t, label in TEMPLATES.items())
OP9_SQL = rf"""
WITH templates(phrase, label, stride) AS (VALUES
    {_T}
),
sizes AS (SELECT *, list_distinct(string_split(phrase, ' ')) AS tokens FROM templates),
wanted AS (SELECT phrase, label, stride, len(tokens) AS size, unnest(tokens) AS token FROM sizes),
d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM d),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w),
base AS (
  SELECT doc_id, i - 1 AS place, CASE
    WHEN w[i] = 'cc' AND w[i + 1] = 'by' THEN 'cc-by'
    WHEN w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license' THEN 'gpl'
    WHEN w[i] = 'all' AND w[i + 1] = 'rights' AND w[i + 2] = 'reserved' THEN 'reserved' END AS label
  FROM p
),
b AS (
  SELECT doc_id, count(*) AS n, min(place) AS f, max(place) AS l, list_sort(list(DISTINCT label)) AS labels
  FROM base WHERE label IS NOT NULL GROUP BY doc_id
),
m AS (
  SELECT doc_id, phrase, label, size, (i - 1) // stride - before AS block, count(DISTINCT token) AS held
  FROM p JOIN wanted ON w[i] = token, (VALUES (0), (1)) blocks(before)
  WHERE (i - 1) // stride >= before
  GROUP BY ALL HAVING count(DISTINCT token) * 10 >= 8 * size
),
s AS (SELECT doc_id, list(DISTINCT label) AS labels, max(held / size) AS best FROM m GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, f AS first_word, l AS last_word,
  coalesce(array_to_string(b.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(s.labels, [])))), ','), '') AS labels,
  CASE WHEN n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN s USING (doc_id)
"""
