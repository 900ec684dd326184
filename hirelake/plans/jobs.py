"""Batch jobs: ingest -> transform -> backfill (JOB1) and the layer build (JOB2).

Every layer is written before the next one reads it, so each stage starts
from a short lineage (a lost executor recomputes at most one stage) and no
DataFrame is evaluated twice.  Tables live under ``root`` - on a cluster a
folder on the shared file system (see ``hirelake.session.scratch_path``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.operators import deadletter as DL
from hirelake.operators import gold as G
from hirelake.operators import silver as S
from hirelake.operators import validate as V
from hirelake.operators.strategy import materialize
from hirelake.plans import manifest as M
from hirelake.plans import sinks
from hirelake.plans.versioned import Table
from hirelake.sources.landed import path_has_data


@dataclass(frozen=True)
class Tables:
    """Folder layout of one deployment."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def bronze(self, spark: SparkSession) -> Table:
        """The bronze table: upserts by posting id, merged on read."""
        return Table(spark, self.path("bronze_jobs"), "id")


GOLD_TABLES = {
    "gold_country_trends": G.gold_country_trends,
    "gold_skill_trends": G.gold_skill_trends,
    "gold_role_trends": G.gold_role_trends,
    "gold_time_trends": G.gold_time_trends,
}


def ingest(spark: SparkSession, raw: DataFrame, t: Tables, run_source: str = fixed.DEFAULT_SOURCE,
           ingested_at: Column | None = None) -> DataFrame:
    """Validate a raw batch once, upsert valid rows into bronze, append dead letters.

    Returns the one-row ingest summary (VAL9).
    """
    staged = t.path(f"_staging/validated-{run_source}")
    if "_pos" not in raw.columns:  # landing order, or else any order that a rerun repeats
        raw = raw.withColumn("_pos", F.struct("_file", "_line", "_idx") if "_file" in raw.columns
                             else F.xxhash64(*raw.columns))
    V.staged(V.validate(raw, run_source, ingested_at)).write.mode("overwrite").option("compression", "zstd").parquet(staged)
    checked = spark.read.parquet(staged)
    valid = checked.filter(F.col("error_message").isNull()).select(*V.BRONZE_COLUMNS, "_pos")
    t.bronze(spark).upsert(valid, "_pos", keep_first=["ingested_at"], stored=True)
    sinks.append_new(V.dead_letters(checked, run_source), t.path("bronze_jobs_dead_letter"))
    summary = materialize(V.ingest_summary(checked, run_source))
    M.delete(spark, staged)
    return summary


def run_transformations(spark: SparkSession, t: Tables, flavour: str = "python") -> DataFrame:
    """JOB2: silver from bronze, then the four gold tables; returns AGG6 counts.

    Silver is written once and re-read, so the four aggregations scan the
    narrow silver columns instead of re-running enrichment.
    """
    bronze = sinks.read_table(spark, t.path("bronze_jobs"))
    builder = S.silver_jobs if flavour == "python" else S.silver_jobs_sql
    # Silver is laid out by month (partition pruning for month filters); the
    # rebalance hint lets AQE split a month that holds a large share of rows
    # into several files instead of one task writing it.
    silver_df = builder(bronze).hint("rebalance", "published_month")
    silver_path = sinks.write_table(silver_df, t.path("silver_jobs"), partition_by=["published_month"])
    silver = spark.read.parquet(silver_path)
    gold = {}
    for name, fn in GOLD_TABLES.items():
        gold[name] = spark.read.parquet(sinks.write_table(fn(silver), t.path(name)))
    return G.transform_summary(bronze, silver, gold)


def dead_letters(spark: SparkSession, t: Tables) -> DataFrame:
    """The dead-letter table in its current state.

    Two append-only folders: the letters, and a log of what each backfill
    pass found out.  Neither is ever rewritten; the state is their fold.
    """
    log = t.path("bronze_jobs_dead_letter_outcomes")
    log = spark.read.parquet(log) if path_has_data(spark, log) else None
    return DL.with_outcomes(spark.read.parquet(t.path("bronze_jobs_dead_letter")), log)


def backfill(spark: SparkSession, t: Tables, limit: int | None = 100, now: Column | None = None) -> DataFrame:
    """DL3-DL7: retry unresolved dead letters, upsert recoveries, log the outcome.

    The next pass reads the log, so it retries only what is still open.
    """
    run = uuid.uuid4().hex
    staged = t.path(f"_staging/retry-{run}")
    V.staged(DL.retry(dead_letters(spark, t), limit)).write.parquet(staged)
    retried = spark.read.parquet(staged)
    recovered = retried.filter("recoverable").select(*V.BRONZE_COLUMNS, "_dl_id")
    t.bronze(spark).upsert(recovered, "_dl_id", keep_first=["ingested_at"], stored=True)
    DL.outcomes(retried, run, now).write.mode("append").parquet(t.path("bronze_jobs_dead_letter_outcomes"))
    summary = materialize(DL.backfill_summary(retried))
    M.delete(spark, staged)
    return summary


def run_all(spark: SparkSession, raw: DataFrame, t: Tables, run_source: str = fixed.DEFAULT_SOURCE,
            backfill_limit: int | None = 100, now: Column | None = None) -> DataFrame:
    """JOB1: ingest -> transform -> backfill; one summary row.

    Backfill runs after the transform, so recovered postings reach silver
    on the next run (as in the reference flow).  A failing ingest raises and
    nothing after it runs.
    """
    ing = ingest(spark, raw, t, run_source)
    trans = run_transformations(spark, t)
    bf = backfill(spark, t, backfill_limit, now)
    names = ["bronze_jobs", "silver_jobs", *GOLD_TABLES]
    counts = [trans.filter(F.col("table_name") == n).select("row_count").scalar().alias(n + "_rows")
              for n in names]
    return ing.select(
        "source", "status", "fetched", "valid", "invalid", *counts,
    ).select("*", bf.select("retried").scalar().alias("retried"),
             bf.select("recovered").scalar().alias("recovered"),
             bf.select("failed").scalar().alias("failed"))
