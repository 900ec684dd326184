"""Join strategies shared by the matching operators.

``broadcast_if_small`` broadcasts a side only when Spark's own size estimate
is within a byte bound; above it the plain (sort-merge) join is kept.
``salted_join`` splits keys that hold a large share of one side across
sub-keys, more for a larger share, and replicates the other side's rows for
exactly those keys, so a term held by a third of all rows is spread over many
tasks instead of one.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.session import checkpoint_root, scratch_path

# Estimated bytes we allow to be shipped to every executor.
BROADCAST_MAX_BYTES = 64 << 20
# Rows of one key that a task should join at most.
ROWS_PER_SALT = 100_000


def is_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether the estimated size of ``df`` is at most ``max_bytes``.

    Callers pass stored frames (``materialize``), whose estimate is their file size.
    """
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` when ``is_small``, else ``df``."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder as Parquet and read it back.

    Used before a frame is both counted (size checks, hot keys) and joined,
    so its lineage is computed once, a lost executor re-reads stored files
    instead of recomputing upstream stages, and readers prune columns.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dematerialize(df: DataFrame) -> None:
    """Remove the files of a frame from ``materialize`` once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove_folder(spark, folder)


def remove_folder(spark, path: str) -> None:
    """Delete a folder below the shared scratch folder."""
    if f"{checkpoint_root(spark)}/hirelake/".split(":", 1)[-1].lstrip("/") not in path:
        raise ValueError(f"not a scratch folder: {path}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def source_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, by Spark's own estimate."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: Spark removes them when a write is done."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def observed(df: DataFrame, metrics: dict[str, Column]) -> tuple[DataFrame, dict]:
    """(stored ``df``, metrics): aggregates collected while it is written, no second scan."""
    seen = Observation()
    stored = materialize(df.observe(seen, *[c.alias(name) for name, c in metrics.items()]))
    return stored, seen.get


def ensure_parallelism(df: DataFrame) -> DataFrame:
    """Spread a scan over at least one task per core.

    A few large files (or one small file holding long texts) can give a scan
    fewer partitions than there are cores; the CPU-heavy text work after it
    then runs in a handful of tasks.  Only in that case the rows are spread
    round-robin; a scan over many files is returned unchanged.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def hot_keys(df: DataFrame, key: str, min_rows: int) -> DataFrame:
    """``(key, _n)`` of keys holding more than ``min_rows`` rows (pre-aggregated, map-side)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > min_rows)


def salted_join(big: DataFrame, small: DataFrame, key: str, salt_by: str,
                rows_per_salt: int = ROWS_PER_SALT) -> DataFrame:
    """Exact inner equi-join on ``key`` with hot keys split by their row count.

    ``big`` rows of a key with n > ``rows_per_salt`` rows get one of
    ``ceil(n / rows_per_salt)`` salts by the hash of ``salt_by``; ``small``
    rows of that key are replicated once per salt.  Cold keys keep salt 0 on
    both sides.  There are at most rows(big) / rows_per_salt hot keys.
    """
    hot = materialize(hot_keys(big, key, rows_per_salt).select(
        key, F.ceil(F.col("_n") / rows_per_salt).cast("int").alias("_ways")))
    hot = broadcast_if_small(hot)
    ways = F.coalesce(F.col("_ways"), F.lit(1))
    b = big.join(hot, key, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(F.col(salt_by)), ways).cast("int")).drop("_ways")
    s = small.join(hot, key, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), ways - 1))).drop("_ways")
    return b.join(s, [key, "_salt"]).drop("_salt")


def top_k_per_key(df: DataFrame, key: str, order: list[Column], k: int, salt: int = 16, salt_by: str = "job_id") -> DataFrame:
    """Exact top-k per key in two phases (salted partial top-k, then final); ``_r``: the rank."""
    salted = df.withColumn("_s", F.pmod(F.xxhash64(F.col(salt_by)), F.lit(salt)))
    w1 = Window.partitionBy(key, "_s").orderBy(*order)
    part = salted.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k).drop("_s")
    w2 = Window.partitionBy(key).orderBy(*order)
    return part.withColumn("_r", F.row_number().over(w2)).filter(F.col("_r") <= k)
