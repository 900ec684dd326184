"""Helpers shared by the training-data operators.

* ``stored``: write a frame once to the shared scratch folder and read it back;
  ``consumed``: a block at whose end the frames stored in it are removed.
* ``small_batches``: bounded Arrow batches where whole documents pass Python.
* ``text_blocks`` / ``word_hashes`` / ``shingles``: numpy over Arrow string
  buffers, a bounded block of bytes at a time; no Python string per word.
* ``ranked``: gapless rank inside a key, without the key's rows in one task.
* ``join_unique``: join to a side that is unique on the key; hot keys are
  looked up through a bounded broadcast, the rest by a shuffle join.
* ``broadcast_if_few``: broadcast of narrow rows behind a count.
* ``components``: connected components by alternating large and small stars.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.session import checkpoint_root, scratch_path

BLOCK_BYTES = 1 << 20
HOT_MAX = 2000  # at most this many keys are ever treated as hot
FEW = 1_000_000  # a narrow frame is broadcast up to so many rows (some tens of MB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most ``rows`` rows in an Arrow batch of this session: batches of whole
    documents that go to Python and back are held several times over."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


_SCOPES: list[list[str]] = []  # folders written in the open ``consumed`` blocks


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``stored`` wrote."""
    if f"{checkpoint_root(spark)}/hirelake/" not in path:
        raise ValueError(f"not a stored intermediate: {path}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def consumed(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Whatever is stored inside is removed at the end, but for what the yielded
    function stores: the results (their folders: ``keep.paths``), which belong to the
    block around, if any.

    >>> with consumed(spark) as keep:
    ...     out = keep(work(stored(rows, "rows")), "result")
    """
    own: list[str] = []
    results: list[str] = []

    def keep(df: DataFrame, name: str) -> DataFrame:
        out = stored(df, name)
        results.append(own.pop())
        return out

    keep.paths = results
    _SCOPES.append(own)
    try:
        yield keep
    finally:
        _SCOPES.pop()
        for path in own:
            remove(spark, path)
        if _SCOPES:
            _SCOPES[-1].extend(results)


def keyed(rows: DataFrame, names: list[str] | None = None, out: str = "key") -> DataFrame:
    """Rows of a file scan, their columns as ``names``, with ``out``: a number of their
    own, from the file's number and the row's place in it.  Files are numbered by
    name, in one task: their names only."""
    names = names or rows.columns
    cols = [F.col(f"`{c}`").alias(n) for c, n in zip(rows.columns, names)]
    placed = rows.select(*cols, F.col("_metadata.file_path").alias("_f"), F.col("_metadata.row_index").alias("_i"))
    files = stored(placed.select("_f").distinct(), "files")
    files = stored(files.select("_f", F.row_number().over(Window.orderBy("_f")).cast("long").alias("_n")), "files")
    return placed.join(files, "_f").select(*[f"`{n}`" for n in names], (F.shiftleft("_n", 40) + F.col("_i")).alias(out))


# --- ranks and joins ------------------------------------------------------

def ranked(df: DataFrame, keys: list[str], order: list[str], out: str = "rank",
           rows_per_bucket: int = 50_000) -> DataFrame:
    """Add ``out``: 0, 1, 2 ... within ``keys`` without gaps.

    Rows of a key are dealt over hash buckets whose number grows with the
    frame, ranked there, and shifted by the counts of the earlier buckets, so
    a key that holds a third of all rows is ranked by many tasks.  ``df``
    should be stored: it is counted first.  Equal ``order`` values get
    different ranks in an unspecified order.
    """
    buckets = max(1, -(-df.count() // rows_per_bucket))
    spread = df.withColumn("_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    shift = Window.partitionBy(*keys).orderBy("_b")
    starts = (
        spread.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.sum("_n").over(shift) - F.col("_n")).drop("_n")
    )
    inner = Window.partitionBy(*keys, "_b").orderBy(*order)
    return (
        spread.withColumn("_r", F.row_number().over(inner) - 1)
        .join(starts, [*keys, "_b"])
        .withColumn(out, (F.col("_start") + F.col("_r")).cast("long"))
        .drop("_b", "_r", "_start")
    )


def join_unique(left: DataFrame, right: DataFrame, keys: list[str], count: str,
                total: int, how: str = "inner") -> DataFrame:
    """Join ``left`` to ``right`` (unique on ``keys``, non-null keys).

    ``right[count]`` says how many rows of ``left`` carry the key.  Keys with
    more than ``total / HOT_MAX`` of them are fewer than ``HOT_MAX``; they are
    broadcast, and only the other rows are shuffled.
    """
    least = max(1000, total // HOT_MAX)
    extra = [c for c in right.columns if c not in keys and c != count]
    hot = F.broadcast(
        right.filter(F.col(count) > least)
        .select(*keys, F.struct(F.lit(True).alias("_is"), *extra).alias("_hot")))
    marked = left.join(hot, keys, "left")
    done = marked.filter(F.col("_hot").isNotNull()).select(*left.columns, *[F.col(f"_hot.{c}").alias(c) for c in extra])
    rest = marked.filter(F.col("_hot").isNull()).select(*left.columns)
    cold = rest.join(right.filter(F.col(count) <= least).select(*keys, *extra), keys, how)
    return done.unionByName(cold.select(*done.columns))


def broadcast_if_few(df: DataFrame) -> DataFrame:
    """``df``, a stored frame of narrow rows, marked for broadcast if it has at
    most FEW of them; beyond that Spark joins it by a shuffle."""
    return F.broadcast(df) if df.count() <= FEW else df


BITS_MAX = 27  # a bitmap has at most 2^27 bits (16 MB)


def bitmap(values: DataFrame, col: str) -> np.ndarray:
    """Bits set at the leading bits of 64-bit hashes, 16 bits for each of them but
    2^BITS_MAX at most: a filter of bounded size that lets some others pass.  Built by
    an aggregation; at most 2^(BITS_MAX - 6) rows reach the driver."""
    bits = min(BITS_MAX, max(16, (16 * values.count()).bit_length()))
    at = values.select(F.shiftrightunsigned(col, 64 - bits).alias("at"))
    words = at.selectExpr("shiftright(at, 6) as w", "shiftleft(1L, cast(at & 63 as int)) as m")
    got = words.groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got["w"].to_numpy(np.int64)] = got["m"].to_numpy(np.int64)
    return out.view(np.uint8)


def in_bitmap(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) have their bit set."""
    at = h >> U(64 - int(len(bits) * 8).bit_length() + 1)
    return (bits[(at >> U(3)).astype(np.int64)] >> (at & U(7)).astype(np.uint8)) & 1 == 1


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) of every id that occurs in ``edges`` (a, b).

    ``component`` is the smallest id reachable.  Alternating large-star and
    small-star rounds; each round is two aggregations and two joins over the
    edge list, stored in the shared folder, so lineage stays short and nothing
    is collected but a count and a checksum.
    """
    e = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v").distinct(), "edges")
    seen = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        e = stored(small.filter("u <> v").distinct(), "edges")
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


# --- numpy over Arrow text ------------------------------------------------

def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if offs is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, off


def text_blocks(col: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0): whole texts, about
    ``block_bytes`` at a time (one longer text makes a block of its own)."""
    buf, off = text_buffer(col)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + block_bytes, "right")) - 1)
        yield i, j, buf[off[i]: off[j]], off[i: j + 1] - off[i]
        i = j


U = np.uint64
_MIX1, _MIX2, _STEP = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit."""
    x = (x ^ (x >> U(30))) * _MIX1
    x = (x ^ (x >> U(27))) * _MIX2
    return x ^ (x >> U(31))


#: ASCII space and 0x09-0x0D end a word; A-Z count as a-z.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = mix64(np.arange(1, 257, dtype=U) * _STEP)[LOWER]  # a random number per lower-cased byte
_BASE = 0x5851F42D4C957F2D
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + (1 << 17))
        for name, b in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(size, U(b))
            p[0] = U(1)
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def word_spans(buf: np.ndarray, off: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word of a block; bytes marked in ``between``
    (ASCII space) stand between words."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~between[buf]
    first = np.zeros(len(buf) + 1, bool)  # a row's first byte begins a new word
    first[off[:-1]] = True
    before = np.empty(len(buf), bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | first[:-1]))
    after = np.empty(len(buf), bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | first[1:])) + 1
    if len(ends) < len(starts):  # the last byte of the block always ends a word
        ends = np.append(ends, len(buf))
    return starts, ends, np.searchsorted(off, starts, "right") - 1


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, heads: tuple[int, ...] = ()):
    """64-bit hash of every word, A-Z as a-z: a polynomial over random byte
    numbers, read off one running sum.  With ``heads``, also a list of hashes
    of the words' first so many bytes."""
    up, down = _powers(len(buf) + 1)
    total = np.empty(len(buf) + 1, U)
    total[0] = 0
    np.cumsum(_BYTE[buf] * up[: len(buf)], out=total[1:])
    span = lambda e: mix64((total[e] - total[starts]) * down[starts] + (e - starts).astype(U) * _STEP)
    if heads:
        return span(ends), [span(np.minimum(starts + n, ends)) for n in heads]
    return span(ends)


def joined_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, end): the words again, one space between any two, A-Z as a-z."""
    size = ends - starts
    new = np.concatenate([[0], np.cumsum(size + 1)[:-1]]) if len(size) else size
    out = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    if len(size):
        at = np.arange(len(out)) + np.repeat(starts - new, size + 1)  # the byte after a word gives way to the space
        at[new + size] = 0
        out = LOWER[buf[at]]
        out[new + size] = 0x20
    return out, new, new + size


def shingles(words: np.ndarray, row: np.ndarray, rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``k`` words; a row with 1 to k-1 words gives
    its whole sequence as one shingle."""
    n = len(words)
    parts_h, parts_r = [], []
    if n >= k:
        h = np.full(n - k + 1, U(k))
        for i in range(k):
            h = mix64(h * _MIX2 + words[i: n - k + 1 + i])
        ok = row[: n - k + 1] == row[k - 1:]
        parts_h.append(h[ok])
        parts_r.append(row[: n - k + 1][ok])
    count = np.bincount(row, minlength=rows)
    begin = np.concatenate([[0], np.cumsum(count)[:-1]])
    for m in range(1, k):
        r = np.flatnonzero(count == m)
        if len(r):
            h = np.full(len(r), U(m))
            for i in range(m):
                h = mix64(h * _MIX2 + words[begin[r] + i])
            parts_h.append(h)
            parts_r.append(r)
    if not parts_h:
        return np.zeros(0, U), np.zeros(0, np.int64)
    h, r = np.concatenate(parts_h), np.concatenate(parts_r)
    return h, r


def shingle_sets(col: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text of the column."""
    for _, _, buf, off in text_blocks(col):
        starts, ends, row = word_spans(buf, off)
        h, r = shingles(word_hashes(buf, starts, ends), row, len(off) - 1, k)
        order = np.argsort(r, kind="stable")
        h, cut = h[order], np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(off) - 1))])
        for i in range(len(off) - 1):
            yield np.unique(h[cut[i]: cut[i + 1]])


def spread_scan(df: DataFrame) -> DataFrame:
    """Rows dealt round-robin when the scan has fewer parts than cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def text_or_empty(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
