"""Registered sink, batch-job and streaming queries (SNK1, SNK3-SNK5, JOB1, JOB2, STR1-STR3).

Each writes its tables under a fresh folder below the shared checkpoint
root and returns what it wrote, read back from storage.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelake.operators import changes as C
from hirelake.operators import validate as V
from hirelake.plans import jobs as J
from hirelake.plans import layers as L
from hirelake.plans import oracle as O
from hirelake.plans import sinks
from hirelake.plans.catalog import register
from hirelake.plans.catalog_match import BOOKMARKS_SQL
from hirelake.plans.versioned import Table
from hirelake.plans.views import KEYS as VIEW_KEYS
from hirelake.session import scratch_path
from hirelake.sources import landed as LD
from hirelake.sources import landing as LG
from hirelake.sources import testdata as TD
from hirelake.streaming import ingest as ST


def _update_batch(spark, sf):
    """A re-delivery: every third posting with a new title, every ninth twice (last wins)."""
    v = L.validated(spark, sf).filter(F.col("error_message").isNull())
    first = v.filter(F.col("_pos") % 3 == 0).select(
        *[F.concat(F.col("title"), F.lit(" (updated)")).alias("title") if c == "title" else
          (F.col("ingested_at") + F.expr("INTERVAL 30 DAYS")).alias("ingested_at") if c == "ingested_at" else F.col(c)
          for c in V.BRONZE_COLUMNS], (F.col("_pos") * 2).alias("_seq"))
    second = v.filter(F.col("_pos") % 9 == 0).select(
        *[F.concat(F.col("title"), F.lit(" (v2)")).alias("title") if c == "title" else
          (F.col("ingested_at") + F.expr("INTERVAL 31 DAYS")).alias("ingested_at") if c == "ingested_at" else F.col(c)
          for c in V.BRONZE_COLUMNS], (F.col("_pos") * 2 + 1).alias("_seq"))
    return first.unionByName(second)


@register("bronze_upsert", O.with_layers(
    "SELECT b.id, CASE WHEN b.id % 9 = 0 THEN b.title || ' (v2)' WHEN b.id % 3 = 0 THEN b.title || ' (updated)' "
    "ELSE b.title END AS title, b.ingested_at FROM bronze b", upto="bronze"))
def q_bronze_upsert(spark, sf):
    """SNK1: re-delivered postings replace bronze rows; first ingested_at is kept."""
    table = Table(spark, scratch_path(spark, "bronze"))
    table.refresh(L.bronze_dealt(spark, sf), dealt=True)
    table.upsert(_update_batch(spark, sf), "_seq", keep_first=["ingested_at"])
    return table.read().select("id", "title", "ingested_at")


_SMALL_BATCH = "id >= (SELECT max(o_orderkey) FROM orders) * 99 / 100"


@register("bronze_upsert_small", O.with_layers(
    f"SELECT id, CASE WHEN {_SMALL_BATCH} THEN title || ' (late)' ELSE title END AS title, ingested_at, "
    f"{_SMALL_BATCH} AS changed FROM bronze", upto="bronze"))
def q_bronze_upsert_small(spark, sf):
    """SNK1: a batch of the last hundredth of the keys; the change feed names its rows."""
    table = Table(spark, scratch_path(spark, "bronze"))
    first = table.refresh(L.bronze_dealt(spark, sf), dealt=True)
    last = spark.read.parquet(f"{sf}/orders.parquet").agg((F.max("o_orderkey") * 99 / 100).alias("k")).scalar()
    late = table.read().filter(F.col("id") >= last).withColumns({
        "title": F.concat("title", F.lit(" (late)")), "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 9 DAYS"),
        "_seq": F.lit(1)})
    now = table.upsert(late, "_seq", keep_first=["ingested_at"])
    feed = table.changes(first, now).filter("old.title <> new.title").select("key", F.lit(True).alias("changed"))
    rows = table.read().select("id", "title", "ingested_at")
    return rows.join(feed, rows["id"] == feed["key"], "left").select(
        "id", "title", "ingested_at", F.coalesce("changed", F.lit(False)).alias("changed"))


@register("bronze_compact", O.with_layers(
    "SELECT id, CASE WHEN id % 8 = 0 THEN title ELSE title || ' (' || CAST(id % 8 AS VARCHAR) || ')' END AS title FROM bronze",
    upto="bronze"))
def q_bronze_compact(spark, sf):
    """SNK1: seven upserts merged into the base files."""
    table = Table(spark, scratch_path(spark, "bronze"))
    table.refresh(L.bronze_dealt(spark, sf), dealt=True)
    rows = table.read()
    for k in range(1, 8):
        table.upsert(rows.filter(F.col("id") % 8 == k).withColumns({
            "title": F.concat("title", F.lit(f" ({k})")), "_seq": F.lit(k)}), "_seq")
    table.compact()
    return table.read().select("id", "title")


@register("table_refresh", O.with_layers("SELECT * FROM gold_time", upto="gold"))
def q_table_refresh(spark, sf):
    """SNK3: two refreshes of a table; readers see the newest complete version."""
    root = scratch_path(spark, "gold_time")
    sv = L.silver(spark, sf)
    from hirelake.operators import gold as G
    sinks.write_table(G.gold_time_trends(sv.filter(F.col("job_id") % 2 == 0)), root)
    sinks.write_table(G.gold_time_trends(sv), root)
    return sinks.read_table(spark, root)


@register("csv_export", O.with_layers(
    "SELECT role, avg_salary, min_salary, max_salary, job_count, currency FROM ("
    "SELECT role, round_even(avg((salary_min + salary_max) / 2), 2) AS avg_salary, round_even(min(salary_min), 2) "
    "AS min_salary, round_even(max(salary_max), 2) AS max_salary, count(*) AS job_count, 'USD' AS currency "
    "FROM silver WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL AND salary_currency = 'USD' "
    "GROUP BY role ORDER BY avg((salary_min + salary_max) / 2) DESC, role LIMIT 20)"))
def q_csv_export(spark, sf):
    """SNK4: the salary-by-role table exported as CSV and read back."""
    from hirelake.operators import serving as SV
    path = scratch_path(spark, "salary-csv")
    sinks.csv_export(SV.salary_by_role(L.silver(spark, sf)), path)
    schema = "role STRING, avg_salary DOUBLE, min_salary DOUBLE, max_salary DOUBLE, job_count LONG, currency STRING"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


@register("snapshot_copy", O.with_layers(
    "SELECT 'bronze_jobs' AS table_name, (SELECT count(*) FROM bronze) AS src_rows, "
    "(SELECT count(*) FROM bronze) AS dst_rows UNION ALL "
    "SELECT 'silver_jobs', (SELECT count(*) FROM silver), (SELECT count(*) FROM silver) UNION ALL "
    "SELECT 'gold_country_trends', (SELECT count(*) FROM gold_country), (SELECT count(*) FROM gold_country)",
    upto="gold"))
def q_snapshot_copy(spark, sf):
    """SNK5: copy written tables (a missing one is skipped) and reconcile row counts.  Each
    table is made from the one written before it."""
    from hirelake.operators import gold as G
    from hirelake.operators import silver as S
    root = scratch_path(spark, "snapshot-src")

    def stored(df, name):
        df.write.option("compression", "zstd").parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")

    sv = stored(S.silver_jobs(stored(L.bronze(spark, sf), "bronze_jobs")), "silver_jobs")
    G.gold_country_trends(sv).write.parquet(f"{root}/gold_country_trends")
    tables = {n: f"{root}/{n}" for n in ("bronze_jobs", "bronze_jobs_dead_letter", "silver_jobs",
                                         "gold_country_trends")}
    return sinks.snapshot_copy(spark, tables, scratch_path(spark, "snapshot-dst"))


_NINE = {
    "bronze_jobs": "bronze", "bronze_jobs_dead_letter": "dead", "silver_jobs": "silver", "gold_country_trends": "gold_country",
    "gold_skill_trends": "gold_skill", "gold_role_trends": "gold_role", "gold_time_trends": "gold_time",
    "email_subscriptions": "subs", "bookmarked_jobs": "bookmarks"}


@register("snapshot_copy_all", "WITH " + ",".join([O.RAW, O.VALIDATED, O.BRONZE, O.SILVER, O.GOLD, O.DEAD, O.SUBSCRIPTIONS, BOOKMARKS_SQL])
          + " " + " UNION ALL ".join(f"SELECT '{t}' AS table_name, (SELECT count(*) FROM {v}) AS src_rows, "
                                     f"(SELECT count(*) FROM {v}) AS dst_rows, true AS same_content" for t, v in _NINE.items()))
def q_snapshot_copy_all(spark, sf):
    """SNK5: all nine tables copied, their contents compared by fingerprints."""
    t = J.Tables(scratch_path(spark, "snapshot-src"))
    J.ingest(spark, L.raw(spark, sf), t)
    J.run_transformations(spark, t)
    tables = {n: sinks.read_table(spark, t.path(n)) for n in _NINE if n not in (
        "bronze_jobs_dead_letter", "email_subscriptions", "bookmarked_jobs")}
    tables["bronze_jobs_dead_letter"] = J.dead_letters(spark, t)
    tables["email_subscriptions"] = C.subscription_state(TD.subscription_events(spark, sf))
    tables["bookmarked_jobs"] = C.bookmark_state(TD.bookmark_events(spark, sf))
    return sinks.verified_copy(spark, tables, scratch_path(spark, "snapshot-dst"))


@register("run_transformations", O.with_layers(
    "SELECT 'bronze_jobs' AS table_name, count(*) AS row_count FROM bronze UNION ALL "
    "SELECT 'silver_jobs', count(*) FROM silver UNION ALL "
    "SELECT 'gold_country_trends', count(*) FROM gold_country UNION ALL "
    "SELECT 'gold_skill_trends', count(*) FROM gold_skill UNION ALL "
    "SELECT 'gold_role_trends', count(*) FROM gold_role UNION ALL "
    "SELECT 'gold_time_trends', count(*) FROM gold_time", upto="gold"))
def q_run_transformations(spark, sf):
    """JOB2: write silver and gold from a written bronze table; counts of what was written."""
    t = J.Tables(scratch_path(spark, "layers"))
    sinks.write_table(L.bronze(spark, sf), t.path("bronze_jobs"))
    return J.run_transformations(spark, t)


@register("run_all", O.with_dead(
    "SELECT 'remotive' AS source, 'success' AS status, (SELECT count(*) FROM validated) AS fetched, "
    "(SELECT count(*) FROM bronze) AS valid, (SELECT count(*) FROM dead) AS invalid, "
    "(SELECT count(*) FROM bronze) AS bronze_jobs_rows, (SELECT count(*) FROM silver) AS silver_jobs_rows, "
    "(SELECT count(*) FROM gold_country) AS gold_country_trends_rows, "
    "(SELECT count(*) FROM gold_skill) AS gold_skill_trends_rows, "
    "(SELECT count(*) FROM gold_role) AS gold_role_trends_rows, "
    "(SELECT count(*) FROM gold_time) AS gold_time_trends_rows, "
    "(SELECT count(*) FROM retry) AS retried, (SELECT count(*) FILTER (WHERE retry_error IS NULL) FROM retry) AS recovered, "
    "(SELECT count(*) FILTER (WHERE retry_error IS NOT NULL) FROM retry) AS failed"))
def q_run_all(spark, sf):
    """JOB1: ingest -> transform -> backfill over every raw posting (no backfill cap)."""
    t = J.Tables(scratch_path(spark, "run"))
    return J.run_all(spark, L.raw(spark, sf), t, backfill_limit=None, now=F.lit("2001-09-01").cast("timestamp"))


@register("backfill_twice", O.with_dead(
    "SELECT id, (retry_error IS NULL) AS resolved, CASE WHEN retry_error IS NULL THEN 0 ELSE 2 END AS retry_count, "
    "(SELECT count(*) FILTER (WHERE retry_error IS NOT NULL) FROM retry) AS retried_again, 0 AS recovered_again FROM retry"))
def q_backfill_twice(spark, sf):
    """DL4 / DL5 stored: the second pass retries only what the first left open."""
    t = J.Tables(scratch_path(spark, "backfill"))
    J.ingest(spark, L.raw(spark, sf), t)
    J.backfill(spark, t, limit=None)
    again = J.backfill(spark, t, limit=None)
    return J.dead_letters(spark, t).select(
        "id", "resolved", "retry_count", again.select("retried").scalar().alias("retried_again"),
        again.select("recovered").scalar().alias("recovered_again"))


@register("dead_letter_replay", O.with_layers(
    "SELECT id, url, error_message FROM ("
    "SELECT coalesce(id, '') AS id, coalesce(url, '') AS url, coalesce("
    + O.rules_sql("coalesce(id, '')", "coalesce(url, '')", "coalesce(title, '')", "coalesce(company_name, '')", "'kaggle'")
    + ", NULL) AS error_message FROM raw) WHERE error_message IS NOT NULL", upto="validated"))
def q_dead_letter_replay(spark, sf):
    """SNK2: half of the CSV postings are ingested, a second file lands, all are ingested
    again; every failing record is stored once."""
    (raw, describe), path = TD.described_late(spark, sf), scratch_path(spark, "csv")
    t = J.Tables(scratch_path(spark, "replay"))
    for n in range(2):
        LG.land_csv(raw.filter(F.col("_pos") % 2 == n), f"{path}/{1 - n}", describe)
        J.ingest(spark, LD.src_csv(spark, f"{path}/*").drop("source"), t, "kaggle")
    dead = spark.read.parquet(t.path("bronze_jobs_dead_letter"))
    return dead.select(F.get_json_object("raw_data", "$.id").alias("id"), F.get_json_object("raw_data", "$.url").alias("url"),
                       "error_message")


@register("stream_dead_letters", O.with_dead("SELECT p_id, error_message FROM dead"))
def q_stream_dead_letters(spark, sf):
    """STR1 / STR3: dead letters of the same files ingested twice; each is stored once."""
    t = _stream_bronze(spark, sf, runs=2)
    dead = spark.read.parquet(t.path("bronze_jobs_dead_letter"))
    return dead.select(F.get_json_object("raw_data", "$.id").alias("p_id"), "error_message")


def _stream_bronze(spark, sf, runs: int = 1):
    raw, describe = TD.described_late(spark, sf)
    landing = scratch_path(spark, "landing")
    LG.land_envelopes(raw, landing, page_size=500, with_drops=False, describe=describe)
    t = J.Tables(scratch_path(spark, "stream-tables"))
    for _ in range(runs):
        q = ST.start_ingest(spark, landing, t, scratch_path(spark, "stream-ckpt"), max_files=2)
        ST.run_until_idle(q)
    return t


_STREAM_SQL = O.with_layers("SELECT id, url, title, source, tags, publication_date FROM bronze", upto="bronze")


@register("stream_ingest", _STREAM_SQL)
def q_stream_ingest(spark, sf):
    """STR1: landed envelope files ingested by an availableNow file stream."""
    t = _stream_bronze(spark, sf)
    return sinks.read_table(spark, t.path("bronze_jobs")).select(
        "id", "url", "title", "source", "tags", "publication_date")


@register("stream_gold", O.with_layers("SELECT * FROM gold_time", upto="gold"))
def q_stream_gold(spark, sf):
    """STR2: gold time trends refreshed by the stream's micro-batches."""
    t = _stream_bronze(spark, sf)
    return ST.gold(spark, t, "gold_time_trends")


@register("stream_gold_updates", (lambda moved: O.with_layers(
    "SELECT view, key, published_month, count(*) AS job_count FROM ("
    + " UNION ALL ".join(f"SELECT '{v}' AS view, {k} AS key, published_month FROM {moved}" for v, k in (
        ("gold_country_trends", "country"), ("gold_role_trends", "role"), ("gold_time_trends", "CAST(NULL AS VARCHAR)")))
    + f" UNION ALL SELECT 'gold_skill_trends', unnest(tags), published_month FROM {moved}) GROUP BY ALL"))(
        "(SELECT CASE WHEN job_id % 14 = 0 THEN 'Atlantis' ELSE country END AS country, role, tags, "
        "CASE WHEN job_id % 7 = 0 THEN CAST(date_trunc('month', publication_date + INTERVAL 40 DAY) AS DATE) "
        "ELSE published_month END AS published_month FROM silver)"))
def q_stream_gold_updates(spark, sf):
    """STR2: later files move every seventh posting 40 days on and every fourteenth to
    another country; all four gold tables follow."""
    raw, describe = TD.described_late(spark, sf)
    landing, ckpt = scratch_path(spark, "landing"), scratch_path(spark, "stream-ckpt")
    t = J.Tables(scratch_path(spark, "stream-tables"))
    k = F.col("_pos")
    later = raw.filter(k % 7 == 0).withColumns({
        "publication_date": F.date_format(F.to_timestamp("publication_date") + F.expr("INTERVAL 40 DAYS"), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "candidate_required_location": F.when(k % 14 == 0, "Atlantis").otherwise(F.col("candidate_required_location"))})
    for n, rows in enumerate((raw, later)):
        LG.land_envelopes(rows, f"{landing}/{n}", page_size=500, with_drops=False, describe=describe)
        ST.run_until_idle(ST.start_ingest(spark, f"{landing}/*", t, ckpt, max_files=4))
    parts = [ST.gold(spark, t, v) for v in VIEW_KEYS]
    out = None
    for (view, key), part in zip(VIEW_KEYS.items(), parts):
        part = part.select(F.lit(view).alias("view"), (F.col(key) if key else F.lit(None).cast("string")).alias("key"),
                           "published_month", "job_count")
        out = part if out is None else out.unionByName(part)
    return out


@register("stream_idempotence", _STREAM_SQL)
def q_stream_idempotence(spark, sf):
    """STR3: the same landed files ingested twice (fresh checkpoints) leave bronze unchanged."""
    t = _stream_bronze(spark, sf, runs=2)
    return sinks.read_table(spark, t.path("bronze_jobs")).select(
        "id", "url", "title", "source", "tags", "publication_date")
