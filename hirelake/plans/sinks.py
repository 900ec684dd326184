"""Table writes: refresh, keyed upsert, appends, exports (SNK1-SNK5).

Plain Parquet has no MERGE.  A table is a log of manifests beside its data
folders (``manifest``): a write goes to a new folder and becomes visible when its
manifest is committed, so no job overwrites what it reads, a failed write
leaves the table as it was, and of two writers one wins and the other retries.
Upserts into stored tables are merge-on-read (``versioned``); ``upsert`` here is the
same fold over two frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from hirelake.plans import manifest as M
from hirelake.plans.versioned import RETRIES, Table
from hirelake.sources.landed import path_has_data

KEEP = 5  # versions of a refreshed table that are kept


def read_table(spark: SparkSession, root: str) -> DataFrame | None:
    """Newest version of a table, or None when it has none."""
    m = M.load(spark, root)
    if m is None:
        return None
    if "key" in m:
        return Table(spark, root, m["key"]).read(m["version"])
    return spark.read.parquet(f"{root}/{m['files'][0]['path']}")


def write_table(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    """SNK3: full refresh as a new version; returns the path of its data."""
    spark = df.sparkSession
    known = M.versions(spark, root)
    folder = M.data_folder(known[-1] if known else -1)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).option("compression", "zstd").parquet(f"{root}/{folder}")
    for _ in range(RETRIES):  # a refresh does not depend on the version before it
        known = M.versions(spark, root)
        try:
            M.commit(spark, root, {"op": "refresh", "files": [{"path": folder}]}, known[-1] + 1 if known else 0)
            M.expire(spark, root, KEEP)
            return f"{root}/{folder}"
        except M.Conflict:
            continue
    raise M.Conflict(f"{root}: {RETRIES} tries to commit")


def upsert(existing: DataFrame | None, incoming: DataFrame, key: str = "id",
           seq_col: str = "_seq", keep_first: list[str] | None = None) -> DataFrame:
    """SNK1: keyed upsert - incoming rows replace existing ones, last one wins.

    Among incoming duplicates the highest ``seq_col`` (batch position, or any
    reproducible order) wins;
    ``keep_first`` columns (``ingested_at``) keep the value of the oldest
    version of the key.  One partial aggregation per key: a key repeated in
    a third of the rows is pre-reduced in every map task.
    """
    keep_first = keep_first or []
    cols = [c for c in incoming.columns if c != seq_col]
    seq_type = incoming.schema[seq_col].dataType
    inc = incoming.select(*cols, F.lit(1).alias("_new"), F.col(seq_col).alias("_seq"))
    if existing is not None:
        old = existing.select(*cols, F.lit(0).alias("_new"), F.lit(None).cast(seq_type).alias("_seq"))
        inc = old.unionByName(inc)
    order = F.struct("_new", "_seq")
    aggs = [F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_row")]
    aggs += [F.min_by(F.col(c), order).alias("_first_" + c) for c in keep_first]
    out = inc.groupBy(key).agg(*aggs)
    return out.select(*[F.col("_first_" + c).alias(c) if c in keep_first else F.col("_row." + c).alias(c)
                        for c in cols])


def append_new(df: DataFrame, root: str, key: str = "id") -> None:
    """SNK2: append rows whose key is not yet stored (idempotent on retries)."""
    spark = df.sparkSession
    if path_has_data(spark, root):
        stored = spark.read.parquet(root).select(key)
        df = df.join(stored, key, "left_anti")
    df.write.mode("append").option("compression", "zstd").parquet(root)


def csv_export(df: DataFrame, path: str) -> None:
    """SNK4: CSV with header; array columns as JSON text."""
    out = df.select(*[
        F.to_json(F.col(f.name)).alias(f.name) if f.dataType.typeName() in ("array", "map", "struct")
        else F.col(f.name) for f in df.schema.fields
    ])
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def snapshot_copy(spark: SparkSession, tables: dict[str, str], dst_root: str) -> DataFrame:
    """SNK5: copy each table (skipping missing or empty ones) and reconcile counts.

    Returns ``(table_name, src_rows, dst_rows)``; tables are copied in the
    given order.  Counts come from the parquet footers (no data scan).
    """
    rows = []
    for name, src in tables.items():
        if not path_has_data(spark, src):
            continue
        df = spark.read.parquet(src)
        src_rows = df.count()
        if src_rows == 0:
            continue
        dst = f"{dst_root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(dst)
        rows.append((name, src_rows, spark.read.parquet(dst).count()))
    return spark.createDataFrame(rows, "table_name STRING, src_rows LONG, dst_rows LONG")


def fingerprint(df: DataFrame) -> dict[str, Column]:
    """Row count and an order-independent content fingerprint, as aggregates: the sum
    and the exclusive or of the rows' hashes (equal rows count as often as they occur)."""
    row = F.xxhash64(*[F.to_json(c) if t.startswith(("map", "struct")) else F.col(c) for c, t in df.dtypes])
    return {"rows": F.count(F.lit(1)), "total": F.sum(row.cast("decimal(20,0)")), "mixed": F.bit_xor(row)}


def verified_copy(spark: SparkSession, tables: dict[str, DataFrame | None], dst_root: str) -> DataFrame:
    """SNK5: copy each table (missing and empty ones are skipped) and compare contents.

    The source's fingerprint is observed while it is copied, so it is read once;
    the copy's is taken from the files written.  Returns (table_name, src_rows,
    dst_rows, same_content).
    """
    rows = []
    for name, df in tables.items():
        if df is None or df.isEmpty():
            continue
        seen = Observation()
        dst = f"{dst_root}/{name}"
        df.observe(seen, *[c.alias(k) for k, c in fingerprint(df).items()]).write.mode("overwrite").option(
            "compression", "zstd").parquet(dst)
        rows.append((name, *_compared(seen.get, spark.read.schema(df.schema).parquet(dst))))
    return spark.createDataFrame(rows, "table_name STRING, src_rows LONG, dst_rows LONG, same_content BOOLEAN")


def _compared(src: dict, copy: DataFrame) -> tuple[int, int, bool]:
    got = copy.agg(*[c.alias(k) for k, c in fingerprint(copy).items()]).first().asDict()
    return src["rows"], got["rows"], all(src[k] == got[k] for k in got)


def check_copy(src: DataFrame, copy: DataFrame) -> tuple[int, int, bool]:
    """(rows, rows of the copy, same content) of two stored tables."""
    return _compared(src.agg(*[c.alias(k) for k, c in fingerprint(src).items()]).first().asDict(), copy)
