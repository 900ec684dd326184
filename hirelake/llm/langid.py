"""Language identification: multinomial naive Bayes over hashed character n-grams.

Fitting counts the hashed 1- to ``N``-grams of every labelled text per language
in numpy, one sparse row per (language, bucket) and task, and sums them in
Spark.  The log-probability matrix (buckets x languages) is broadcast; texts
are scored a block at a time by gathering its rows and summing per text.

Characters are lower-cased; every character that is not a letter counts as a
space, and runs of them as one.  An n-gram does not reach beyond its text.

Defined results: a null text or one without a letter is ``und`` with score 0; if
nothing was learned every text is ``und``; a null label is not learned from but
its text is predicted; equal scores go to the first language by name; repeated
rows count as often as they occur; an empty table gives an empty result; extra
columns are kept by ``predict``'s caller through the id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common as C

N = 3                 # longest n-gram
BUCKETS = 1 << 16     # per n-gram length above 1 they share one hash space
ALPHA = 0.5           # added to every count
LANGS_MAX = 1000      # a column with more values is not a language label
UNDETERMINED = "und"
BLOCK_BYTES = C.BLOCK_BYTES // 8  # text at once: its n-grams take some 180 times that


@dataclass(frozen=True)
class Model:
    langs: list[str]
    logp: np.ndarray   # (BUCKETS, langs) float32
    prior: np.ndarray  # (langs,) float64


_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        t = np.zeros(0x110000, bool)
        t[[c for c in range(0x30000) if chr(c).isalpha()]] = True
        t[0x30000:0x32000] = True  # further ideographs
        _LETTER.append(t)
    return _LETTER[0]


def _grams(col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, hashed n-grams, their rows, rows with a letter)."""
    for lo, hi, buf, off in C.text_blocks(col, BLOCK_BYTES):
        # byte offsets to code point offsets: continuation bytes begin none
        begins = (buf & 0xC0) != 0x80
        cut = np.concatenate([[0], np.cumsum(begins)])[off]
        text = buf.tobytes().decode("utf-8", "replace")
        low = text.lower()
        if len(low) != len(text):  # a few letters grow when lower-cased
            low = "".join(c.lower()[0] for c in text)
        cp = np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32)
        letter = _letters()[cp]
        row = np.repeat(np.arange(hi - lo), np.diff(cut))
        has = np.zeros(hi - lo, bool)
        has[row[letter]] = True
        code = np.where(letter, cp, 32)
        keep = letter.copy()
        if len(keep):  # the first of a run of other characters stays, as a space
            keep[1:] |= letter[:-1] & (row[1:] == row[:-1])
        code, row = code[keep].astype(np.uint64), row[keep]
        hs, rs = [], []
        h = code
        for n in range(1, N + 1):
            if n > 1:
                if len(code) < n:
                    break
                h = (h[:-1] * C.U(0x9E3779B1) + code[n - 1:]) if n > 2 else (code[:-1] * C.U(0x9E3779B1) + code[1:])
            ok = row[: len(row) - n + 1] == row[n - 1:]
            mixed = (h * C.U(0xD6E8FEB86659FD93) + C.U(n)) >> C.U(40)
            hs.append((mixed & C.U(BUCKETS - 1)).astype(np.int64)[ok])
            rs.append(row[: len(row) - n + 1][ok])
        yield lo, hi, np.concatenate(hs), np.concatenate(rs), has


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts of all rows with a text and a label; no sampling."""
    seen = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            coded = batch.column(0).dictionary_encode()
            names, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            sums = np.zeros(len(names) * BUCKETS, np.int64)
            for lo, _, h, r, _ in _grams(batch.column(1)):
                sums += np.bincount(code[lo + r] * BUCKETS + h, minlength=len(sums)) if len(h) else 0
            for i, name in enumerate(names):
                part = sums[i * BUCKETS: (i + 1) * BUCKETS]
                total[name] = total.get(name, 0) + np.append(part, (code == i).sum())
        for name, t in total.items():
            at = np.flatnonzero(t)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(t[at], pa.int64())],
                names=["lang", "bucket", "n"])

    sums = C.stored(C.spread_scan(seen).mapInArrow(run, "lang string, bucket int, n long")
                    .groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "gram-counts")
    known = sums.filter(F.col("bucket") == BUCKETS).orderBy(F.desc("n"), "lang").limit(LANGS_MAX)
    langs = sorted(r[0] for r in known.select("lang").collect())
    sums = sums.join(F.broadcast(known.select("lang")), "lang", "left_semi")
    counts = np.zeros((BUCKETS + 1, len(langs)))
    got = sums.toPandas()  # at most LANGS_MAX x (BUCKETS + 1) rows, whatever the input
    counts[got["bucket"], np.searchsorted(langs, got["lang"].tolist())] = got["n"]
    docs_n, counts = counts[BUCKETS], counts[:BUCKETS] + ALPHA
    return Model(langs, np.log(counts / counts.sum(axis=0)).astype(np.float32),
                 np.log(docs_n / max(1, docs_n.sum()) if len(langs) else docs_n))


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred, score (posterior probability) per row."""
    rows = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = rows.drop("_text").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            n = batch.num_rows
            best, score = np.full(n, -1), np.zeros(n)
            for lo, hi, h, r, has in _grams(batch.column(len(keep))) if m.langs else ():
                own = np.empty((hi - lo, len(m.langs)))
                for j in range(len(m.langs)):
                    own[:, j] = np.bincount(r, weights=m.logp[h, j], minlength=hi - lo) + m.prior[j]
                top = own.argmax(axis=1)
                p = 1 / np.exp(own - own.max(axis=1, keepdims=True)).sum(axis=1)
                best[lo:hi], score[lo:hi] = np.where(has, top, -1), np.where(has, p, 0.0)
            names = [*m.langs, UNDETERMINED]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([names[i] for i in best], pa.string()), pa.array(score)],
                names=schema.names)

    return C.spread_scan(rows).mapInArrow(run, schema)
