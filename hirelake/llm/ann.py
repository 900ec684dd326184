"""Approximate nearest neighbours by cross-polytope hashing, exactly reranked.

Vectors are scaled to unit length, with one more coordinate that makes the
largest inner product the smallest angle, and turned by three rounds of random
signs and a fast Hadamard transform.  A table's hash is the nearest signed axis
among the first ``d`` coordinates; a second polytope joins once one table's
buckets would grow beyond ``BUCKET`` vectors.  A query visits, in every table,
the buckets of the axes that are next nearest; what it finds there is scored by
the exact inner product of the original vectors in double precision.

How many buckets a query visits is fitted: a bounded sample of ``SAMPLE``
queries is answered by brute force over all rows, and the fewest visits that
reach ``RECALL`` on it are taken.  All rows are indexed and nothing is capped:
a large bucket is split into chunks, and a query visits all of them.

Defined results: vectors that are null, zero, of another length than the most
common one or that hold null or non-finite components take no part, as query or
candidate; repeated ids are candidates once each; equal scores go to the smaller
id; of more than k + 1 equal vectors only the smallest ids can be among the
nearest k, so only they are indexed; with at most ``BUCKET`` vectors all buckets
are visited; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm import common as C

TABLES = 8
BUCKET = 2000
CHUNK = 8192
SAMPLE = 64
RECALL = 0.96
SEED = 11


@dataclass(frozen=True)
class Index:
    dim: int
    norm: float      # largest length of a vector
    first: int       # coordinates of the first polytope
    second: int      # and of the second, 0 if there is none
    tables: int = TABLES

    @property
    def wide(self) -> int:
        return 1 << int(np.ceil(np.log2(self.dim + 1)))

    @property
    def buckets(self) -> int:
        return 2 * self.first * max(1, 2 * self.second)

    def turned(self, v: np.ndarray, table: int) -> np.ndarray:
        """Pseudo-rotation of a table: random signs and Hadamard, three times."""
        rng = np.random.default_rng([SEED, table])
        x = np.zeros((len(v), self.wide))
        x[:, : v.shape[1]] = v
        for _ in range(3):
            x *= rng.choice([-1.0, 1.0], self.wide)
            step = 1
            while step < self.wide:
                y = x.reshape(len(v), -1, 2, step)
                x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(v), self.wide)
                step *= 2
            x /= np.sqrt(self.wide)
        return x

    def nearness(self, v: np.ndarray, table: int) -> np.ndarray:
        """How near each vector is to every bucket of a table."""
        x = self.turned(v, table)
        one = np.concatenate([x[:, : self.first], -x[:, : self.first]], axis=1)
        if not self.second:
            return one
        rest = x[:, self.first: self.first + self.second] if self.first + self.second <= self.wide \
            else x[:, : self.second][:, ::-1]
        two = np.concatenate([rest, -rest], axis=1)
        return (one[:, :, None] + two[:, None, :]).reshape(len(v), -1)

    def unit(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Unit vectors whose inner products order as those of ``v``."""
        if query:
            return np.concatenate([v / np.linalg.norm(v, axis=1, keepdims=True), np.zeros((len(v), 1))], axis=1)
        w = v / self.norm
        return np.concatenate([w, np.sqrt(np.maximum(0.0, 1 - (w * w).sum(axis=1, keepdims=True)))], axis=1)


def _matrix(col: pa.Array, dim: int) -> np.ndarray:
    return col.flatten().to_numpy().astype(np.float64).reshape(-1, dim)


def _size(n: int, dim: int) -> tuple[int, int]:
    """Coordinates of the polytopes for n vectors: buckets of about BUCKET."""
    want = max(4, -(-n // (2 * BUCKET)))
    top = dim + 1
    if want <= top:
        return want, 0
    return top, int(min(top, -(-want // (2 * top))))


def _scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products in double precision, alike wherever a vector stands."""
    return (v * q).sum(axis=1)


def _best(q: np.ndarray, qid: int, v: np.ndarray, vid: np.ndarray, rough: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the k nearest by exact score, then smaller id."""
    if len(rough) > k + 1:
        least = np.partition(rough, len(rough) - k - 1)[len(rough) - k - 1]
        at = np.flatnonzero(rough >= least - 1e-9 * (1 + abs(least)))
    else:
        at = np.arange(len(rough))
    at = at[vid[at] != qid]
    s = _scores(q, v[at])
    top = np.lexsort((vid[at], -s))[:k]
    return at[top], s[top]


def _brute(cand: DataFrame, qid: np.ndarray, q: np.ndarray, k: int, dim: int) -> pd.DataFrame:
    """Exact neighbours of a bounded set of queries: a few rows per task."""
    shared = cand.sparkSession.sparkContext.broadcast((qid, q))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, qs = shared.value
        for b in batches:
            v, vid = _matrix(b.column(1), dim), b.column(0).to_numpy()
            rough = qs @ v.T
            got = [(i, *_best(qs[j], i, v, vid, rough[j], k)) for j, i in enumerate(ids)]
            at = np.concatenate([g[1] for g in got])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, [len(g[1]) for g in got])), pa.array(vid[at]),
                 pa.array(np.concatenate([g[2] for g in got])), b.column(1).take(pa.array(at))],
                names=["query_id", "vec_id", "score", "vec"])

    rows = cand.select("vec_id", "vec").mapInArrow(run, "query_id long, vec_id long, score double, vec array<double>")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).toPandas()


def _visits(x: Index, qid: np.ndarray, q: np.ndarray, truth: pd.DataFrame, recall: float) -> int:
    """Fewest buckets per table with which the sample reaches ``recall``."""
    if not len(truth):
        return x.buckets
    row = {int(i): j for j, i in enumerate(qid)}
    at = np.array([row[i] for i in truth["query_id"]])
    v = np.array(truth["vec"].tolist())
    need = np.full(len(truth), x.buckets)
    for t in range(x.tables):
        near = x.nearness(x.unit(q, True), t)
        bucket = x.nearness(x.unit(v, False), t).argmax(axis=1)
        own = near[at, bucket]
        need = np.minimum(need, (near[at] > own[:, None]).sum(axis=1) + 1)
    return int(np.sort(need)[max(0, int(np.ceil(recall * len(need))) - 1)])


def valid(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vec) of the vectors that take part."""
    df = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    fine = F.expr("vec_id is not null and vec is not null and size(vec) > 0 and forall(vec, x -> x is not null and "
                  "not isnan(x) and abs(x) < double('inf')) and exists(vec, x -> x <> 0)")
    return df.filter(F.coalesce(fine, F.lit(False)))


def nearest(df: DataFrame, is_query: str, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            recall: float = RECALL) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row for
    which the SQL condition ``is_query`` over ``vec_id`` holds."""
    spark = df.sparkSession
    rows = C.stored(valid(df, id_col, vec_col), "vectors")
    shape = rows.groupBy(F.size("vec").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.expr("sqrt(aggregate(vec, 0D, (a, x) -> a + x * x))")).alias("norm"))
    shape = shape.orderBy(F.desc("n"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if shape is None:
        return empty
    dim = shape.d
    rows = rows.filter(F.size("vec") == dim)
    equal = Window.partitionBy(F.xxhash64("vec"), F.hash("vec")).orderBy("vec_id")
    cand = C.stored(rows.distinct().withColumn("_r", F.row_number().over(equal)).filter(F.col("_r") <= k + 1).drop("_r"), "candidates")
    n = cand.count()
    first, second = _size(n, dim)
    x = Index(dim, float(shape.norm) or 1.0, first, second)
    queries = C.stored(rows.filter(is_query), "queries")
    sample = queries.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).toPandas()
    if not len(sample):
        return empty
    qid, q = sample["vec_id"].to_numpy(), np.array(sample["vec"].tolist())
    visits = x.buckets if n <= BUCKET else _visits(x, qid, q, _brute(cand, qid, q, k, dim), recall)
    shared = spark.sparkContext.broadcast(x)

    def hashed(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            x = shared.value
            for b in batches:
                for lo in range(0, b.num_rows, 2048):
                    p = b.slice(lo, 2048)
                    u = x.unit(_matrix(p.column(1), x.dim), query)
                    for t in range(x.tables):
                        near = x.nearness(u, t)
                        if query:
                            top = np.argsort(-near, axis=1, kind="stable")[:, :visits]
                            at, bucket = np.repeat(np.arange(len(u)), top.shape[1]), top.ravel()
                        else:
                            at, bucket = np.arange(len(u)), near.argmax(axis=1)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(at), t, np.int32)), pa.array(bucket.astype(np.int32)),
                             p.column(0).take(pa.array(at)), p.column(1).take(pa.array(at))],
                            names=["table", "bucket", "vec_id", "vec"])
        return run

    schema = "table int, bucket int, vec_id long, vec array<double>"
    entries = C.stored(C.spread_scan(cand).mapInArrow(hashed(False), schema), "entries")
    chunks = entries.groupBy("table", "bucket").agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks"))
    chunks = C.stored(chunks, "chunks")
    # tables x buckets rows: a number of the index, about n / BUCKET of it
    entries = entries.join(chunks, ["table", "bucket"]).select(
        "table", "bucket", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int").alias("chunk"), "vec_id", "vec")
    probes = C.stored(C.spread_scan(queries).mapInArrow(hashed(True), schema), "probes")
    asked = C.stored(probes.groupBy("table", "bucket").agg(
        F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("parts")), "query-parts")
    # a chunk of a bucket meets each part of the bucket's queries in a task of its own
    ways = chunks.select("table", "bucket", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    probes = probes.join(asked, ["table", "bucket"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    probes = probes.drop("parts").join(ways, ["table", "bucket"])
    entries = entries.join(asked, ["table", "bucket"]).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")

    def search(_key, ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        if not len(ours) or not len(theirs):
            return none
        v, vid = np.stack(ours["vec"].to_numpy()), ours["vec_id"].to_numpy()
        out = []
        for lo in range(0, len(theirs), 1024):
            part = theirs.iloc[lo: lo + 1024]
            qs, ids = np.stack(part["vec"].to_numpy()), part["vec_id"].to_numpy()
            rough = qs @ v.T
            out += [(i, *_best(qs[j], i, v, vid, rough[j], k)) for j, i in enumerate(ids.tolist())]
        return pd.DataFrame({"query_id": np.repeat([i for i, _, _ in out], [len(at) for _, at, _ in out]),
                             "vec_id": vid[np.concatenate([at for _, at, _ in out])], "score": np.concatenate([s for *_, s in out])})

    key = ["table", "bucket", "chunk", "part"]
    found = entries.groupBy(*key).cogroup(probes.groupBy(*key)).applyInPandas(
        search, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")) \
        .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
