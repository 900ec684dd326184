"""Language-model scoring by cross-entropy difference.

Two character n-gram models, one of the target texts and one of all texts, share
one vocabulary (the hashed n-grams of the whole corpus) and one smoothing: an
order's estimate falls back on the next shorter one with weight ``BETA``.  The
background's counts are scaled to the target's mass, so that both are smoothed
alike.  A document's score is the mean over its tokens (characters) of the
target loss minus the background loss: low scores are like the target.

Counts are gathered from every text of the corpus, a task's distinct n-grams at
a time, and summed in Spark; the tables that are broadcast are bounded by
``BITS``.

Defined results: a null or empty text has no tokens and null losses; without
target texts the target model is uniform over its fallback; repeated rows count
as often as they occur; an empty table gives an empty result; a null id is
kept and is no target; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common as C

BITS = (16, 20, 22, 22)   # hash bits of the tables of n-grams of 1, 2, 3 and 4 characters
BETA = 4.0
SHIFT = 24
_FOLD = np.arange(0x250, dtype=np.uint32)
_FOLD[48:58] = 48                                   # digits count as one
_FOLD[[9, 10, 11, 12, 13, 0xA0]] = 32
_FOLD[65:91] += 32
_FOLD[0xC0:0xDF] = [c if c == 0xD7 else c + 32 for c in range(0xC0, 0xDF)]


@dataclass(frozen=True)
class Model:
    gram: np.ndarray          # order << SHIFT, plus the hashed n-gram
    target: np.ndarray        # counts; the background's are scaled
    background: np.ndarray

    def tables(self) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The counts by hashed n-gram, one table per order and model; only
        the n-grams that occur are broadcast."""
        order, at = self.gram >> SHIFT, self.gram & ((1 << SHIFT) - 1)
        out = []
        for counts in (self.target, self.background):
            out.append([np.zeros(1 << b, np.float32) for b in BITS])
            for n in range(len(BITS)):
                out[-1][n][at[order == n]] = counts[order == n]
        return out[0], out[1]


def _orders(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, list[np.ndarray]]]:
    """(first row, end row, row of every character, hashed n-grams per order).

    A text begins after ``order - 1`` start marks, so every character has an
    n-gram of every order; the n-gram at a place ends there.
    """
    for lo, hi, buf, off in C.text_blocks(col, C.BLOCK_BYTES // 2):
        cut = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[off]
        cp = np.frombuffer(buf.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
        cp = np.where(cp < len(_FOLD), _FOLD[np.minimum(cp, len(_FOLD) - 1)], cp).astype(C.U)
        row = np.repeat(np.arange(hi - lo), np.diff(cut))
        since = np.arange(len(cp)) - cut[row] if len(cp) else row
        out, h = [], np.zeros(len(cp), C.U)
        scale = C.U(1)
        for n, bits in enumerate(BITS):
            back = np.zeros(len(cp), C.U)      # the character n places before, 1 where the text had not begun
            if len(cp):
                back[n:] = cp[: len(cp) - n]
                back[since < n] = 1
            h = h + back * scale
            scale = np.multiply(scale, C.U(0x9E3779B97F4A7C15), dtype=C.U) if n else C.U(0x9E3779B97F4A7C15)
            out.append((C.mix64(h + C.U(n)) >> C.U(64 - bits)).astype(np.int64))
        yield lo, hi, row, out


def fit(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Models of the texts whose id is in ``target`` (id_col) and of all texts."""
    ids = C.stored(target.select(F.col(id_col).alias("_t")).filter("_t is not null").distinct(), "target")
    ids = C.broadcast_if_few(ids)  # beyond that the texts are shuffled once
    marked = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(
        ids, F.col("_id") == F.col("_t"), "left").select(F.col("_t").isNotNull().alias("is_target"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = [[np.zeros(1 << b, np.int32) for b in BITS] for _ in range(2)]
        for batch in batches:
            good = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
            for lo, _, row, grams in _orders(batch.column(1)):
                mine = good[lo + row]
                for n, g in enumerate(grams):
                    for kind, own in ((0, g[mine]), (1, g)):
                        if len(own):
                            at, many = np.unique(own, return_counts=True)
                            both[kind][n][at] += many.astype(np.int32)
        for n in range(len(BITS)):
            at = np.flatnonzero(both[1][n])
            yield pa.RecordBatch.from_arrays(
                [pa.array((n << SHIFT) + at, pa.int32()), pa.array(both[0][n][at].astype(np.int64)),
                 pa.array(both[1][n][at].astype(np.int64))], names=["gram", "t", "b"])

    sums = marked.mapInArrow(run, "gram int, t long, b long").groupBy("gram").agg(
        F.sum("t").alias("t"), F.sum("b").alias("b"))
    got = C.stored(sums, "ngrams").toPandas()   # at most the tables' fixed size
    gram, t, b = got["gram"].to_numpy(), got["t"].to_numpy(np.float64), got["b"].to_numpy(np.float64)
    single = (gram >> SHIFT) == 0
    if t[single].sum():
        b = b * (t[single].sum() / b[single].sum())
    return Model(gram.astype(np.int32), t.astype(np.float32), b.astype(np.float32))


def _losses(tables: list[np.ndarray], grams: list[np.ndarray], before: list[np.ndarray]) -> np.ndarray:
    """-log2 probability of every character."""
    size = len(tables[0])
    p = (tables[0][grams[0]] + 0.01) / (tables[0].sum(dtype=np.float64) + 0.01 * size)
    for n in range(1, len(grams)):
        p = (tables[n][grams[n]] + BETA * p) / (np.maximum(tables[n - 1][before[n - 1]], tables[n][grams[n]]) + BETA)
    return -np.log2(p)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, loss_target, loss_background, score) per row."""
    rows = C.spread_scan(docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = rows.drop("_text").schema
    for name, kind in (("n_tokens", "long"), ("loss_target", "double"), ("loss_background", "double"), ("score", "double")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value.tables()
        for batch in batches:
            n = np.zeros(batch.num_rows, np.int64)
            loss = np.zeros((2, batch.num_rows))
            for lo, hi, row, grams in _orders(batch.column(1)):
                n[lo:hi] = np.bincount(row, minlength=hi - lo)
                before = []   # the context: the n-gram that ended one place earlier
                for k, g in enumerate(grams[:-1]):
                    c = np.roll(g, 1)
                    before.append(c)
                begins = np.flatnonzero(np.diff(row, prepend=-1))
                for kind, tables in enumerate(models):
                    each = _losses(tables, grams, before)
                    if len(begins):  # the first character has no context but its text's beginning
                        each[begins] = _losses(tables, [g[begins] for g in grams[:1]], [])
                    loss[kind, lo:hi] = np.bincount(row, weights=each, minlength=hi - lo)
            mean = np.where(n > 0, loss / np.maximum(n, 1), np.nan)
            none = n == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(mean[0], mask=none), pa.array(mean[1], mask=none),
                 pa.array(mean[0] - mean[1], mask=none)], names=schema.names)

    return rows.mapInArrow(run, schema)
