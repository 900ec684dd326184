"""Toxicity by a chain of linear classifiers.

Categories are predicted one after another; each logistic model sees the text's
features and the probabilities of the categories before it.  Those that a later
model learns from are out of fold: predicted by a model that did not see the
text.  Features are the presence of a word or of a word's first 4 or 5 bytes,
hashed; the ``FEATURES`` with the largest chi-square against any category are
kept.

Models are fitted on at most ``TRAIN_ROWS`` labelled rows (those with the
smallest hash of the id), a documented bound; every row is scored on its whole
text.

Defined results: a null, empty or wordless text has no features and gets the
models' base rates; a category's threshold is the cut with the fewest errors among
the out-of-fold probabilities; rows with a null label in any category are not learned
from; if nothing is labelled all probabilities are null; repeated rows are
scored alike; an empty table gives an empty result; a null id is kept; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common as C

TRAIN_ROWS = 20_000
BITS = 18
FEATURES = 4096
FOLDS = 4
HEADS = (4, 5)
STEPS = 300        # at most; about 60 are needed
MEMORY = 8         # past steps that L-BFGS keeps
TOLERANCE = 1e-3
RIDGE = 1e-4

_BETWEEN = C.SPACE.copy()
_BETWEEN[[*range(0, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


@dataclass(frozen=True)
class Chain:
    categories: list[str]
    slot: np.ndarray          # bucket -> feature, -1 if it is not kept
    weights: list[np.ndarray]  # per category: features, earlier categories, bias
    thresholds: list[float]    # per category: positive from this probability on


def _threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The cut with the fewest wrong rows among probabilities that were predicted
    out of fold; of equally good ones the middle of the widest gap."""
    order = np.argsort(p, kind="stable")
    p, y = p[order], y[order] > 0.5
    wrong = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum(~y[::-1])[::-1], [0]])
    edge = np.concatenate([[-1e-9], p, [1 + 1e-9]])
    gap = np.diff(edge)  # cut k lies between edge k and edge k + 1
    best = np.flatnonzero((wrong == wrong[gap > 0].min(initial=len(p) + 1)) & (gap > 0))
    k = best[np.argmax(gap[best])] if len(best) else 0
    return float((edge[k] + edge[k + 1]) / 2)


def _features(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, buckets, rows), each bucket once per row."""
    for lo, hi, buf, off in C.text_blocks(col):
        s, e, row = C.word_spans(buf, off, _BETWEEN)
        whole, heads = C.word_hashes(buf, s, e, HEADS)
        hs = [whole] + [C.mix64(h + C.U(n)) for n, h in zip(HEADS, heads)]
        key = np.concatenate([(row << BITS) + (h >> C.U(64 - BITS)).astype(np.int64) for h in hs])
        key = np.unique(key)
        yield lo, hi, key & ((1 << BITS) - 1), key >> BITS


def _sample(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str, text_col: str) -> DataFrame:
    """At most TRAIN_ROWS labelled rows with their texts."""
    known = labels.select(F.col(id_col).alias("_k"), *[F.col(c).cast("double").alias(c) for c in categories]) \
        .dropna().dropDuplicates(["_k"])
    some = F.broadcast(known.orderBy(F.xxhash64("_k"), "_k").limit(TRAIN_ROWS))
    return docs.join(some, F.col(id_col) == F.col("_k")).select("_k", *categories, F.col(text_col).cast("string").alias("text"))


def _select(sample: DataFrame, categories: list[str]) -> np.ndarray:
    """The buckets kept: largest chi-square of presence against a category."""
    n = len(categories)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n + 1, 1 << BITS), np.int64)
        rows = np.zeros(n + 1)
        for b in batches:
            y = np.stack([b.column(j + 1).to_numpy() for j in range(n)])
            rows += np.append(y.sum(axis=1), b.num_rows)
            for lo, _, h, r in _features(b.column(n + 1)):
                sums[n] += np.bincount(h, minlength=1 << BITS)
                for j in range(n):
                    sums[j] += np.bincount(h[y[j][lo + r] > 0], minlength=1 << BITS)
        at = np.append(np.flatnonzero(sums[n]), -1)
        cols = [pa.array(np.append(sums[j][at[:-1]], int(rows[j]))) for j in range(n + 1)]
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *cols],
                                         names=["bucket", *[f"n{j}" for j in range(n + 1)]])

    schema = "bucket int, " + ", ".join(f"n{j} long" for j in range(n + 1))
    got = sample.mapInArrow(run, schema).groupBy("bucket").agg(*[F.sum(f"n{j}").alias(f"n{j}") for j in range(n + 1)])
    got = got.toPandas()  # at most 2 ** BITS rows
    total = got[got["bucket"] == -1]
    got = got[got["bucket"] >= 0]
    if not len(got) or not len(total):
        return np.zeros(0, np.int64)
    rows, seen = float(total[f"n{n}"].iloc[0]), got[f"n{n}"].to_numpy(float)
    best = np.zeros(len(got))
    for j in range(n):
        pos, a = float(total[f"n{j}"].iloc[0]), got[f"n{j}"].to_numpy(float)
        b, c = seen - a, pos - a
        d = rows - a - b - c
        bottom = (a + b) * (c + d) * (a + c) * (b + d)
        best = np.maximum(best, np.where(bottom > 0, rows * (a * d - b * c) ** 2 / np.maximum(bottom, 1), 0))
    order = np.lexsort((got["bucket"].to_numpy(), -best))[:FEATURES]
    return np.sort(got["bucket"].to_numpy()[order]).astype(np.int64)


def _logistic(at: np.ndarray, row: np.ndarray, extra: np.ndarray, y: np.ndarray, size: int,
              ridge_by: float = RIDGE, tolerance: float = TOLERANCE) -> np.ndarray:
    """Weights (features, extra columns, bias) of a ridge logistic model over sparse
    presence features, by L-BFGS until the gradient is ``tolerance`` of the first.

    Features are scaled by the square root of how often they occur, which evens
    out the curvature; the ridge is that of the unscaled weights.
    """
    n, m = extra.shape
    scale = np.ones(size + m + 1)
    scale[:size] = np.sqrt(n / (1.0 + np.bincount(at, minlength=size)))
    ridge = np.full(size + m + 1, ridge_by)
    ridge[-1] = 0

    def loss(u: np.ndarray) -> tuple[float, np.ndarray]:
        w = u * scale
        z = np.bincount(row, weights=w[at], minlength=n) + extra @ w[size:-1] + w[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        r = p - y
        g = np.append(np.append(np.bincount(at, weights=r[row], minlength=size), extra.T @ r), r.sum()) / n + ridge * w
        return float((np.logaddexp(0, z) - y * z).mean() + 0.5 * (ridge * w * w).sum()), g * scale

    u = np.zeros(size + m + 1)
    p = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    u[-1] = np.log(p / (1 - p))
    f, g = loss(u)
    least = tolerance * max(np.abs(g).max(), 1e-9)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(STEPS):
        if np.abs(g).max() <= least:
            break
        d, kept = -g.copy(), []
        for s, c, rho in reversed(past):
            a = rho * (s @ d)
            kept.append(a)
            d -= a * c
        if past:
            s, c, _ = past[-1]
            d *= (s @ c) / (c @ c)
        for (s, c, rho), a in zip(past, reversed(kept)):
            d += (a - rho * (c @ d)) * s
        step, slope = 1.0 if past else min(1.0, 1 / np.abs(g).sum()), g @ d
        while True:
            new = u + step * d
            f2, g2 = loss(new)
            if f2 <= f + 1e-4 * step * slope or step < 1e-10:
                break
            step /= 2
        s, c = new - u, g2 - g
        if s @ c > 1e-12:
            past = [*past[-(MEMORY - 1):], (s, c, 1 / (s @ c))]
        done = f - f2 <= 1e-9 * max(1.0, abs(f))
        u, f, g = new, f2, g2
        if done:
            break
    return u * scale


def _probability(w: np.ndarray, at: np.ndarray, row: np.ndarray, extra: np.ndarray, size: int) -> np.ndarray:
    z = np.bincount(row, weights=w[at], minlength=len(extra)) + extra @ w[size:-1] + w[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _trained(pdf: pd.DataFrame, name: str, before: list[str], size: int, ridge: float, tolerance: float) -> pd.DataFrame:
    """Fit one category's model without the fold ``out`` and predict that fold;
    ``out`` = FOLDS fits on all and returns the weights."""
    out = int(pdf["out"].iloc[0])
    many = pdf["feats"].map(len).to_numpy()
    at = np.concatenate([*pdf["feats"], np.zeros(0)]).astype(np.int64)
    row = np.repeat(np.arange(len(pdf)), many)
    extra = pdf[before].to_numpy(float).reshape(len(pdf), len(before))
    use = (pdf["fold"] != out).to_numpy()
    if not use.any():
        use[:] = True
    renumber = np.cumsum(use) - 1
    inside = use[row]
    w = _logistic(at[inside], renumber[row[inside]], extra[use], pdf[name].to_numpy()[use], size, ridge, tolerance)
    if out == FOLDS:
        return pd.DataFrame({"out": out, "id": np.arange(len(w)), "value": w})
    rest = (pdf["fold"] == out).to_numpy()
    p = _probability(w, at, row, extra, size)[rest]
    return pd.DataFrame({"out": out, "id": pdf["id"].to_numpy()[rest], "value": p})


def _trainer(name: str, before: list[str], size: int, ridge: float, tolerance: float):
    """All models of a category whose folds are in the partition; a fold is the bounded sample."""
    before = list(before)

    def train(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(parts)
        if parts:
            for _, pdf in pd.concat(parts, ignore_index=True).groupby("out"):
                yield _trained(pdf, name, before, size, ridge, tolerance)

    return train


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], id_col: str = "doc_id",
        text_col: str = "text", ridge: float = RIDGE, tolerance: float = TOLERANCE) -> Chain | None:
    """The chain, in the order of ``categories``; None if nothing is labelled."""
    spark, n = docs.sparkSession, len(categories)
    sample = C.stored(_sample(docs, labels, categories, id_col, text_col), "train")
    kept = _select(sample, categories)
    if not len(kept):
        return None
    slot = np.full(1 << BITS, -1, np.int32)
    slot[kept] = np.arange(len(kept))
    size, shared = len(kept), spark.sparkContext.broadcast(slot)

    def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            feats = [np.zeros(0, np.int32)] * b.num_rows
            for lo, hi, h, r in _features(b.column(n + 1)):
                f = shared.value[h]
                r, f = r[f >= 0], f[f >= 0]
                cut = np.searchsorted(r, np.arange(hi - lo + 1))
                for i in range(hi - lo):
                    feats[lo + i] = f[cut[i]: cut[i + 1]]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(feats, pa.list_(pa.int32()))], names=["id", *categories, "feats"])

    labelled = "id long, " + ", ".join(f"`{c}` double" for c in categories) + ", feats array<int>"
    rows = sample.mapInArrow(compact, labelled).withColumn("fold", F.pmod(F.xxhash64("id"), F.lit(FOLDS)).cast("int"))
    rows = C.stored(rows, "train-features")
    weights: list[np.ndarray] = []
    thresholds: list[float] = []
    before: list[str] = []
    for name in categories:
        # one copy of the bounded sample per fold that is left out, and one whole
        copies = rows.withColumn("out", F.explode(F.sequence(F.lit(0), F.lit(FOLDS))))

        copies = copies.repartitionByRange(FOLDS + 1, "out")  # a task for each
        got = C.stored(copies.mapInPandas(_trainer(name, before, size, ridge, tolerance), "out int, id long, value double"), "fits")
        whole = got.filter(F.col("out") == FOLDS).toPandas().sort_values("id")
        weights.append(whole["value"].to_numpy())
        column = f"_p{len(before)}"
        oof = got.filter(F.col("out") < FOLDS).groupBy("id").agg(F.first("value").alias(column))
        rows = C.stored(rows.join(oof, "id", "left").fillna(0.0, [column]), "train-features")
        known = rows.select(column, name).toPandas()  # at most TRAIN_ROWS
        thresholds.append(_threshold(known[column].to_numpy(), known[name].to_numpy()))
        before.append(column)
    return Chain(list(categories), slot, weights, thresholds)


def score(docs: DataFrame, chain: Chain | None, id_col: str = "doc_id", text_col: str = "text",
          categories: list[str] = ()) -> DataFrame:
    """(id_col, p_<category> ...) per row."""
    rows = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    if chain is None:
        return rows.select(id_col, *[F.lit(None).cast("double").alias(f"p_{c}") for c in categories])
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    schema = rows.drop("_text").schema
    for c in chain.categories:
        schema = schema.add(f"p_{c}", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        size = int(m.slot.max()) + 1
        for b in batches:
            p = np.zeros((b.num_rows, len(m.categories)))
            for lo, hi, h, r in _features(b.column(1)):
                f = m.slot[h].astype(np.int64)
                r, f = r[f >= 0], f[f >= 0]
                for j, w in enumerate(m.weights):
                    p[lo:hi, j] = _probability(w, f, r, p[lo:hi, :j], size)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(p[:, j]) for j in range(p.shape[1])]], names=schema.names)

    return C.spread_scan(rows).mapInArrow(run, schema)
