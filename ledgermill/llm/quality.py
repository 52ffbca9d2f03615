"""Quality by positive-unlabelled learning with the non-negative risk."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.common import learns, sampled, table, written

FIT_ROWS = 20_000
"""The classifier is fitted on so many trusted and as many unlabelled documents at most, those with the smallest id hashes."""
HIDDEN, EPOCHS, BATCH, RATE, DECAY, MODELS = 24, 60, 512, 0.01, 1e-3, 3

MEASURES = (
    "words", "bytes", "word_length", "word_spread", "upper", "digits", "signs", "high", "spaces", "breaks", "sign_kinds",
    "distinct", "top_word", "next_same", "pair_repeats", "line_repeats", "sign_words", "lone_signs", "caps_words", "letter_spread",
)

_KIND = np.zeros(256, np.int64)  # 0: lower-case letters
_KIND[65:91] = 1
_KIND[48:58] = 2
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 3
_KIND[[9, 11, 12, 13, 32]] = 4
_KIND[10] = 5
_KIND[128:] = 6


def measures(text: str | None) -> np.ndarray:
    """What a text looks like, as ``MEASURES`` names it: shares and logarithms, all 0 for an empty text."""
    raw = (text or "").encode()
    words = raw.split()
    out = np.zeros(len(MEASURES))
    if not words:
        out[1] = np.log1p(len(raw))
        return out
    values = np.frombuffer(raw, np.uint8)
    chars = np.bincount(values, minlength=256)
    kinds = np.bincount(_KIND, chars, 7) / len(raw)
    length = np.fromiter(map(len, words), np.int64, len(words))
    n, distinct = len(words), set(words)
    signs = chars[_KIND == 3]
    ends = np.cumsum(length)
    packed = np.frombuffer(b"".join(words), np.uint8)
    sign = np.r_[0, np.cumsum(_KIND[packed] == 3)]
    sign_words = sign[ends] - sign[ends - length]
    upper = np.r_[0, np.cumsum(_KIND[packed] == 1)]
    caps = upper[ends] - upper[ends - length]
    numbers = {w: k for k, w in enumerate(distinct)}
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, n)
    pairs = ids[:-1] * len(distinct) + ids[1:]
    lines = [x for x in raw.split(b"\n") if x.strip()]
    shares = chars[chars > 0] / len(raw)
    out[:] = (
        np.log1p(n), np.log1p(len(raw)), length.mean(), length.std(), kinds[1], kinds[2], kinds[3], kinds[6], kinds[4], kinds[5],
        np.log1p((signs > 0).sum()), len(distinct) / n, np.bincount(ids).max() / n,
        (ids[:-1] == ids[1:]).mean() if n > 1 else 0, 1 - len(np.unique(pairs)) / len(pairs) if n > 1 else 0,
        1 - len(set(lines)) / len(lines), (sign_words >= 2).mean(), (sign_words == length).mean(), ((caps >= 2) & (caps * 2 > length)).mean(),
        -(shares * np.log(shares)).sum(),
    )
    return out


@dataclass
class Network:
    """A one-layer network over standardised measures."""

    mean: np.ndarray
    spread: np.ndarray
    weights: list[np.ndarray]

    def margin(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh(self.scaled(x) @ a + b) @ c + d

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.spread, -5, 5)


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, seed: int) -> Network:
    """Minimise the non-negative risk at a class prior; without one, tell trusted from unlabelled rows.

    The risk of a margin g is ``prior * E+[l(g)] + max(0, Eu[l(-g)] - prior *
    E+[l(-g)])`` with the logistic loss l. Where a batch's second term is
    negative, the step climbs out of it instead (the reversed gradient).
    """
    rng = np.random.default_rng(seed)
    both = np.concatenate([positive, unlabelled])
    net = Network(both.mean(axis=0), both.std(axis=0) + 1e-9, [])
    width = both.shape[1]
    net.weights = [rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(())]
    p, u = net.scaled(positive), net.scaled(unlabelled)
    first, second = [np.zeros_like(w) for w in net.weights], [np.zeros_like(w) for w in net.weights]
    step = 0
    batches = max(1, len(u) // BATCH)
    for epoch in range(max(EPOCHS, 400 // batches)):
        rate = RATE * (1 - epoch / max(EPOCHS, 400 // batches)) + 1e-4
        for some_u, some_p in zip(np.array_split(rng.permutation(len(u)), batches), np.array_split(rng.permutation(len(p)), batches), strict=True):
            if not len(some_p):
                some_p = rng.integers(0, len(p), BATCH)
            x = np.concatenate([p[some_p], u[some_u]])
            k = len(some_p)
            a, b, c, d = net.weights
            h = np.tanh(x @ a + b)
            g = h @ c + d
            slope = np.zeros(len(x))
            if prior is None:
                slope[:k], slope[k:] = -_sigmoid(-g[:k]) / k, _sigmoid(g[k:]) / (len(x) - k)
            else:
                negative = _softplus(g[k:]).mean() - prior * _softplus(g[:k]).mean()
                away = _sigmoid(g[k:]) / (len(x) - k)
                back = -prior * _sigmoid(g[:k]) / k
                if negative >= 0:
                    slope[:k], slope[k:] = -prior * _sigmoid(-g[:k]) / k + back, away
                else:
                    slope[:k], slope[k:] = -back, -away
            inner = np.outer(slope, c) * (1 - h**2)
            grads = [x.T @ inner + DECAY * a, inner.sum(axis=0), h.T @ slope + DECAY * c, slope.sum()]
            step += 1
            for w, m, v, grad in zip(range(4), first, second, grads, strict=True):
                m += 0.1 * (grad - m)
                v += 0.001 * (grad * grad - v)
                net.weights[w] = net.weights[w] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled rows.

    A classifier tells trusted from unlabelled rows; on rows it has not seen,
    the share of unlabelled over that of trusted rows above a threshold bounds
    the prior from above, best where few negatives are left in. The smallest
    such bound, with an allowance for small samples, is averaged over two folds.
    """
    found = []
    for fold in range(2):
        net = train(positive[fold::2], unlabelled[fold::2], None, fold)
        p, u = net.margin(positive[1 - fold :: 2]), net.margin(unlabelled[1 - fold :: 2])
        if not len(p) or not len(u):
            continue
        cuts = np.quantile(p, np.linspace(0.0, 0.9, 91))
        above_p = 1 - np.searchsorted(np.sort(p), cuts) / len(p)
        above_u = 1 - np.searchsorted(np.sort(u), cuts) / len(u)
        slack = np.sqrt(np.log(40) / 2) * (len(u) ** -0.5 + len(p) ** -0.5)
        at = ((above_u + slack) / np.maximum(above_p, 1e-9)).argmin()
        found.append(above_u[at] / above_p[at])
    return float(np.clip(np.mean(found), 0.01, 0.99)) if found else 0.5


def fitted(positive: np.ndarray, unlabelled: np.ndarray) -> list[Network]:
    prior = estimated_prior(positive, unlabelled)
    return [train(positive, unlabelled, prior, seed) for seed in range(MODELS)]


def _measured(docs: DataFrame) -> DataFrame:
    """``doc_id, x`` for each row: the measures of its whole text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measures(t.as_py()) for t in batch.column("text")], np.float32).reshape(batch.num_rows, -1)
            flat = pa.ListArray.from_arrays(np.arange(0, found.size + 1, len(MEASURES), dtype=np.int32), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), flat], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(measured, f"doc_id {id_type}, x array<float>")


def _networks(rows: DataFrame, trusted: DataFrame, fit_rows: int, unlabelled) -> list[tuple]:
    """The networks' parts, fitted on bounded samples of measured rows; none without trusted ones."""
    good = sampled(rows.join(trusted.select("doc_id").distinct(), "doc_id", "left_semi"), "doc_id", fit_rows)
    some = sampled(rows.where(unlabelled(F.col("doc_id"))), "doc_id", fit_rows)
    positive, other = _local(good), _local(some)
    nets = fitted(positive, other) if len(positive) > 1 and len(other) > 1 else []
    return [(n.mean, n.spread, n.weights) for n in nets]


def _score(parts: list[tuple], x: np.ndarray) -> np.ndarray:
    margins = [Network(*p).margin(x) for p in parts] or [np.zeros(len(x))]
    return _sigmoid(np.mean(margins, axis=0))


def quality_scores(docs: DataFrame, trusted: DataFrame, fit_rows: int = FIT_ROWS, unlabelled=learns) -> DataFrame:
    """``doc_id, score`` for each row of ``docs(doc_id, text)``: the probability of good quality.

    ``trusted(doc_id)`` names documents known to be good; nothing is taken for
    bad. Measures of every whole text are worked out once and written; the
    network is fitted on a bounded sample of them at an estimated class prior,
    and several fits are averaged. ``unlabelled`` says by id which documents
    the unlabelled sample may hold.

    A null or empty text has measures (zeros) and a score like any other; null
    ids are scored but not learnt from; repeated rows are all scored; an empty
    table gives no rows. Without trusted documents every score is 0.5. Columns
    other than those named are ignored.
    """
    rows = written(_measured(docs))
    parts = _networks(rows, trusted, fit_rows, unlabelled)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().astype(float).reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_score(parts, x))], ["doc_id", "score"])

    return rows.mapInArrow(scored, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")


def _local(df: DataFrame) -> np.ndarray:
    """A bounded sample's measures."""
    got = df.select("x").toArrow().column("x").combine_chunks()
    return got.flatten().to_numpy().astype(float).reshape(-1, len(MEASURES))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled good among those whose labels may be learnt from."""
    return labels.where(F.col("quality") == 1).where(learns(F.col("doc_id"))).select("doc_id")


def accepted(docs: DataFrame, trusted: DataFrame, least: float = 0.5, fit_rows: int = FIT_ROWS) -> DataFrame:
    """``docs`` without the rows whose text scores below ``least``; all columns stay.

    The score is the text's alone, so it is worked out beside each row once the
    networks are fitted: texts are read twice and never shuffled.
    """
    parts = _networks(written(_measured(docs)), trusted, fit_rows, F.isnotnull)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        x = np.array([measures(t) for t in texts], np.float32).reshape(len(texts), -1).astype(float)
        return pd.Series(_score(parts, x))

    return docs.where(score(docs["text"]) >= least)


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document."""
    scores = quality_scores(table(spark, sf_dir, "documents"), trusted_ids(table(spark, sf_dir, "labels")))
    return scores.select(
        "doc_id",
        F.coalesce(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
