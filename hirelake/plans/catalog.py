"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracles.

Every query reads the driver's tables through ``hirelake.plans.layers`` so
its work grows with the data; parameters are the operators' defaults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.plans import layers as L
from hirelake.plans import oracle as O
from hirelake.plans import sinks
from hirelake.operators import serving as SV
from hirelake.operators import validate as V
from hirelake.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# --- validation -----------------------------------------------------------

@register("validate_split", O.with_layers(
    "SELECT id, source, url, title, company_name, job_type, publication_date, ingested_at, error_message "
    "FROM validated", upto="validated"))
def q_validate_split(spark, sf):
    """VAL8: every raw posting with its typed fields and first error."""
    return L.validated(spark, sf).select(
        "id", "source", "url", "title", "company_name", "job_type", "publication_date",
        "ingested_at", "error_message")


@register("silver_jobs", O.with_layers(
    "SELECT job_id, source, title, company_name, category, role, country, tags, publication_date, "
    "published_date, published_month, salary_min, salary_max, salary_currency, seniority FROM silver"))
def q_silver_jobs(spark, sf):
    """SIL8: full bronze -> silver projection."""
    return L.silver(spark, sf)


@register("gold_country_trends", O.with_layers("SELECT * FROM gold_country", upto="gold"))
def q_gold_country(spark, sf):
    return L.gold(spark, sf, "country")


@register("country_trends", O.with_layers(
    "SELECT * FROM gold_country ORDER BY published_month DESC, job_count DESC, country LIMIT 100",
    upto="gold"))
def q_country_trends(spark, sf):
    """FLT1 with default parameters (limit 100)."""
    return SV.key_trends(L.gold(spark, sf, "country"), "country")


# --- gold tables (AGG2, AGG4, AGG5) ----------------------------------------

@register("gold_skill_trends", O.with_layers("SELECT * FROM gold_skill", upto="gold"))
def q_gold_skill(spark, sf):
    return L.gold(spark, sf, "skill")


@register("gold_role_trends", O.with_layers("SELECT * FROM gold_role", upto="gold"))
def q_gold_role(spark, sf):
    return L.gold(spark, sf, "role")


@register("gold_time_trends", O.with_layers("SELECT * FROM gold_time", upto="gold"))
def q_gold_time(spark, sf):
    return L.gold(spark, sf, "time")


# --- filtered trend reads (FLT2-FLT4) ---------------------------------------

@register("skill_trends", O.with_layers(
    "SELECT * FROM gold_skill ORDER BY published_month DESC, job_count DESC, skill LIMIT 100", upto="gold"))
def q_skill_trends(spark, sf):
    return SV.key_trends(L.gold(spark, sf, "skill"), "skill")


@register("role_trends", O.with_layers(
    "SELECT * FROM gold_role ORDER BY published_month DESC, job_count DESC, role LIMIT 100", upto="gold"))
def q_role_trends(spark, sf):
    return SV.key_trends(L.gold(spark, sf, "role"), "role")


@register("time_trends", O.with_layers(
    "SELECT * FROM gold_time ORDER BY published_month LIMIT 100", upto="gold"))
def q_time_trends(spark, sf):
    return SV.time_trends(L.gold(spark, sf, "time"))


@register("country_trends_filtered", O.with_layers(
    "SELECT * FROM gold_country WHERE country ILIKE '%nation_1%' "
    "ORDER BY published_month DESC, job_count DESC, country LIMIT 100", upto="gold"))
def q_country_trends_filtered(spark, sf):
    """FLT1 with the ``ilike %x%`` filter."""
    return SV.key_trends(L.gold(spark, sf, "country"), "country", text="nation_1")


@register("skill_trends_month", O.with_layers(
    "SELECT * FROM gold_skill WHERE published_month = DATE '1996-03-01' "
    "ORDER BY published_month DESC, job_count DESC, skill LIMIT 100", upto="gold"))
def q_skill_trends_month(spark, sf):
    """FLT2 with the month filter."""
    return SV.key_trends(L.gold(spark, sf, "skill"), "skill", month="1996-03-01")


# --- salary (AGG7-AGG9, AGG12, AGG13) ----------------------------------------

def _salary_sql(key: str, currency: str = "USD", limit: int = 20, exclude: list[str] | None = None) -> str:
    excl = ""
    if exclude:
        excl = " AND " + key + " NOT IN (" + ", ".join(f"'{e}'" for e in exclude) + ")"
    return O.with_layers(
        f"SELECT {key}, round_even(avg_salary, 2) AS avg_salary, round_even(min_salary, 2) AS min_salary, "
        f"round_even(max_salary, 2) AS max_salary, job_count, '{currency}' AS currency FROM ("
        f"SELECT {key}, avg((salary_min + salary_max) / 2) AS avg_salary, min(salary_min) AS min_salary, "
        f"max(salary_max) AS max_salary, count(*) AS job_count FROM silver "
        f"WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL AND salary_currency = '{currency}'{excl} "
        f"GROUP BY {key} ORDER BY avg_salary DESC, {key} LIMIT {limit})")


@register("salary_by_role", _salary_sql("role"))
def q_salary_by_role(spark, sf):
    return SV.salary_by_role(L.silver(spark, sf))


@register("salary_by_country", _salary_sql("country", exclude=["Unknown", "Global", "Worldwide", "Remote"]))
def q_salary_by_country(spark, sf):
    return SV.salary_by_country(L.silver(spark, sf))


@register("salary_by_country_eur", _salary_sql("country", "EUR", exclude=["Unknown", "Global", "Worldwide", "Remote"]))
def q_salary_by_country_eur(spark, sf):
    """AGG8 in another currency."""
    return SV.salary_by_country(L.silver(spark, sf), "EUR")


@register("salary_currencies", O.with_layers(
    "SELECT DISTINCT salary_currency FROM silver WHERE salary_currency IS NOT NULL "
    "AND salary_min IS NOT NULL AND salary_currency <> '' ORDER BY 1"))
def q_salary_currencies(spark, sf):
    return SV.salary_currencies(L.silver(spark, sf))


def _salary_all_sql(key: str) -> str:
    return O.with_layers(
        f"SELECT {key}, avg((salary_min + salary_max) / 2) AS avg_salary, min(salary_min) AS min_salary, "
        f"max(salary_max) AS max_salary, count(*) AS job_count FROM silver "
        f"WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL GROUP BY {key}")


@register("salary_by_role_all", _salary_all_sql("title"))
def q_salary_by_role_all(spark, sf):
    """AGG12: grouped by raw title, every currency."""
    return SV.salary_all(L.silver(spark, sf), "title")


@register("salary_by_country_all", _salary_all_sql("country"))
def q_salary_by_country_all(spark, sf):
    """AGG13: grouped by country, no exclusions."""
    return SV.salary_all(L.silver(spark, sf), "country")


# --- top-k over gold (TOP1-TOP12) ----------------------------------------------

def _top_sql(table: str, key: str, n: int, exclude: list[str] | None = None) -> str:
    excl = ""
    if exclude:
        excl = " WHERE " + key + " NOT IN (" + ", ".join(f"'{e}'" for e in exclude) + ")"
    return (f"SELECT {key}, sum(job_count) AS total FROM {table}{excl} GROUP BY {key} "
            f"ORDER BY total DESC, {key} LIMIT {n}")


@register("top_countries", O.with_layers(_top_sql("gold_country", "country", 15), upto="gold"))
def q_top_countries(spark, sf):
    return SV.top_by_total(L.gold(spark, sf, "country"), "country", 15)


@register("top_skills", O.with_layers(_top_sql("gold_skill", "skill", 15), upto="gold"))
def q_top_skills(spark, sf):
    return SV.top_by_total(L.gold(spark, sf, "skill"), "skill", 15)


@register("country_heatmap", O.with_layers(_top_sql("gold_country", "country", 15, ["Unknown", "Global"]), upto="gold"))
def q_country_heatmap(spark, sf):
    return SV.top_by_total(L.gold(spark, sf, "country"), "country", 15, exclude=["Unknown", "Global"])


@register("skill_treemap", O.with_layers(_top_sql("gold_skill", "skill", 15), upto="gold"))
def q_skill_treemap(spark, sf):
    """TOP4: top min(30, N) skills with N = 15."""
    return SV.top_by_total(L.gold(spark, sf, "skill"), "skill", min(30, 15))


@register("top_roles", O.with_layers(_top_sql("gold_role", "role", 15), upto="gold"))
def q_top_roles(spark, sf):
    return SV.top_by_total(L.gold(spark, sf, "role"), "role", 15)


@register("country_monthly_top", O.with_layers(
    "SELECT g.* FROM gold_country g WHERE country IN (SELECT country FROM ("
    + _top_sql("gold_country", "country", 15) + "))", upto="gold"))
def q_country_monthly_top(spark, sf):
    return SV.monthly_of_top(L.gold(spark, sf, "country"), "country", 15)


@register("skill_momentum", O.with_layers(
    "SELECT g.* FROM gold_skill g WHERE skill IN (SELECT skill FROM ("
    + _top_sql("gold_skill", "skill", 8) + "))", upto="gold"))
def q_skill_momentum(spark, sf):
    """TOP7: top min(8, N) skills, N = 15."""
    return SV.monthly_of_top(L.gold(spark, sf, "skill"), "skill", min(8, 15))


@register("role_month_pivot", O.with_layers(
    "SELECT * FROM (WITH top AS (SELECT role FROM (" + _top_sql("gold_role", "role", 15) + ")), "
    "cnt AS (SELECT * FROM gold_role WHERE role IN (SELECT role FROM top)), "
    "months AS (SELECT DISTINCT published_month FROM cnt) "
    "SELECT t.role, m.published_month, coalesce(c.job_count, 0) AS job_count "
    "FROM top t CROSS JOIN months m LEFT JOIN cnt c ON c.role = t.role AND c.published_month = m.published_month)",
    upto="gold"))
def q_role_month_pivot(spark, sf):
    return SV.role_month_matrix(L.gold(spark, sf, "role"), 15)


@register("role_month_matrix", O.with_layers(
    "PIVOT (SELECT role, published_month, job_count FROM gold_role WHERE role IN (SELECT role FROM ("
    + _top_sql("gold_role", "role", 15) + "))) ON published_month USING coalesce(sum(job_count), 0) GROUP BY role", upto="gold"))
def q_role_month_matrix(spark, sf):
    """TOP8 with a column per month."""
    return SV.role_month_table(L.gold(spark, sf, "role"), 15)


@register("country_ranking", O.with_layers(
    "SELECT country, total, row_number() OVER (ORDER BY total DESC, country) AS rank FROM ("
    + _top_sql("gold_country", "country", 50) + ")", upto="gold"))
def q_country_ranking(spark, sf):
    return SV.country_ranking(L.gold(spark, sf, "country"), 50)


@register("time_kpis", O.with_layers(
    "SELECT sum(job_count) AS total_jobs, "
    "arg_max(published_month, job_count * 100000 - (published_month - DATE '1970-01-01')) AS peak_month, "
    "max(job_count) AS peak_count FROM gold_time", upto="gold"))
def q_time_kpis(spark, sf):
    return SV.time_kpis(L.gold(spark, sf, "time"))


@register("salary_kpis", "SELECT avg(avg_salary) AS mean_avg_salary, "
          "arg_min(role, (-avg_salary, role)) AS top_role, max(avg_salary) AS top_avg_salary, "
          "sum(job_count) AS jobs_analysed FROM (" + _salary_sql("role").replace("WITH ", "WITH ", 1) + ")")
def q_salary_kpis(spark, sf):
    return SV.salary_kpis(SV.salary_by_role(L.silver(spark, sf)))


@register("skill_options", O.with_layers(
    "SELECT DISTINCT skill FROM gold_skill ORDER BY skill", upto="gold"))
def q_skill_options(spark, sf):
    return SV.skill_options(L.gold(spark, sf, "skill"))


# --- dead letters (SNK2, DL1-DL7) ------------------------------------------------

from hirelake.operators import deadletter as DL  # noqa: E402
from hirelake.operators import silver as SI  # noqa: E402
from hirelake.operators.strategy import materialize, observed  # noqa: E402

AS_OF = "2001-09-01 00:00:00"


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


def _dead(spark, sf):
    """The dead letters, stored: later filters meet plain columns, not the validation."""
    return materialize(V.dead_letters(L.validated(spark, sf)))


def _after_pass(spark, sf):
    """Dead letters after one backfill pass; letters and retried rows are stored first."""
    dead = _dead(spark, sf)
    return DL.apply_outcome(dead, materialize(DL.retry(dead, None).select("_dl_id", "recoverable")), _as_of())


@register("dead_letter_append", O.with_dead(
    "SELECT id, source, raw_data, error_message, resolved, retry_count, created_at, resolved_at FROM dead"))
def q_dead_letter_append(spark, sf):
    """SNK2: half of the letters appended, then all of them; each is stored once."""
    path = scratch_path(spark, "dead-letters")
    dead = _dead(spark, sf)
    sinks.append_new(dead.filter("id % 2 = 0"), path)
    sinks.append_new(dead, path)
    return spark.read.parquet(path)


@register("dl_unresolved", O.with_dead(
    "SELECT id, source, error_message, created_at FROM dead WHERE NOT resolved "
    "ORDER BY created_at, id LIMIT 100"))
def q_dl_unresolved(spark, sf):
    return DL.unresolved(_dead(spark, sf), 100).select("id", "source", "error_message", "created_at")


@register("dl_sanitize_url", O.with_dead("SELECT id, p_url AS url, s_url AS sanitized_url FROM retry"))
def q_dl_sanitize_url(spark, sf):
    """DL2 over every unresolved payload url."""
    p = DL.payload_frame(DL.unresolved(_dead(spark, sf), None))
    return p.select(F.col("_dl_id").alias("id"), "url", DL.sanitize_url(F.col("url")).alias("sanitized_url"))


@register("dl_dry_run", O.with_dead(
    "SELECT id, source, retry_count, CASE WHEN retry_error IS NULL THEN 'RECOVERABLE' "
    "ELSE 'STILL INVALID (' || retry_error || ')' END AS status FROM retry"))
def q_dl_dry_run(spark, sf):
    return DL.dry_run(_dead(spark, sf), None)


@register("backfill_summary", O.with_dead(
    "SELECT count(*) AS retried, count(*) FILTER (WHERE retry_error IS NULL) AS recovered, "
    "count(*) FILTER (WHERE retry_error IS NOT NULL) AS failed FROM retry"))
def q_backfill_summary(spark, sf):
    return DL.backfill_summary(DL.retry(_dead(spark, sf), None))


@register("dl_dry_run_totals", O.with_dead(
    "SELECT count(*) AS inspected, count(*) FILTER (WHERE retry_error IS NULL) AS recoverable, "
    "count(*) FILTER (WHERE retry_error IS NOT NULL) AS unrecoverable FROM retry"))
def q_dl_dry_run_totals(spark, sf):
    """DL6: the totals that a dry run ends with."""
    return DL.dry_run_totals(DL.retry(_dead(spark, sf), None))


@register("dl_promote", O.with_dead(
    "SELECT CAST(p_id AS BIGINT) AS id, s_url AS url, trim(p_title) AS title, trim(p_source) AS source "
    "FROM retry WHERE retry_error IS NULL"))
def q_dl_promote(spark, sf):
    """DL3: bronze rows recovered from dead letters."""
    return DL.recovered_rows(DL.retry(_dead(spark, sf), None)).select("id", "url", "title", "source")


@register("dl_apply_outcome", O.with_dead(
    "SELECT d.id, (d.resolved OR coalesce(r.retry_error IS NULL, false)) AS resolved, "
    "d.retry_count + CASE WHEN r.id IS NOT NULL AND r.retry_error IS NOT NULL THEN 1 ELSE 0 END AS retry_count, "
    f"CASE WHEN r.id IS NOT NULL AND r.retry_error IS NULL THEN TIMESTAMP '{AS_OF}' ELSE d.resolved_at END AS resolved_at "
    "FROM dead d LEFT JOIN retry r ON r.id = d.id"))
def q_dl_apply_outcome(spark, sf):
    """DL4 + DL5: resolved flags and retry counts after one backfill pass."""
    return _after_pass(spark, sf).select("id", "resolved", "retry_count", "resolved_at")


@register("ingest_summary", O.with_layers(
    "SELECT 'remotive' AS source, CASE WHEN count(*) > 0 THEN 'success' ELSE 'empty' END AS status, "
    "count(*) AS fetched, count(*) FILTER (WHERE error_message IS NULL) AS valid, "
    "count(*) FILTER (WHERE error_message IS NOT NULL) AS invalid FROM validated", upto="validated"))
def q_ingest_summary(spark, sf):
    """VAL9."""
    return V.ingest_summary(L.validated(spark, sf), "remotive")


@register("stats_overview", O.with_dead(
    "SELECT (SELECT count(id) FROM bronze) AS total_jobs, "
    "(SELECT list_sort(list(DISTINCT source)) FROM bronze) AS sources, "
    "(SELECT CAST(min(publication_date) AS DATE) FROM bronze) AS earliest_job, "
    "(SELECT CAST(max(publication_date) AS DATE) FROM bronze) AS latest_job, "
    "(SELECT count(*) FILTER (WHERE NOT resolved) FROM dead) AS total_dead_letters, "
    "(SELECT count(DISTINCT country) FROM gold_country) AS total_countries, "
    "(SELECT count(DISTINCT skill) FROM gold_skill) AS total_skills"))
def q_stats_overview(spark, sf):
    """AGG10: raw postings are validated and stored once, counted on the way; silver's
    distinct countries and skills come from one scan of what was stored."""
    ok = F.col("error_message").isNull()
    checked, seen = observed(L.validated(spark, sf, fields={"candidate_required_location", "tags"}), {
        "total_jobs": F.count(F.when(ok, F.col("id"))), "sources": F.sort_array(F.collect_set(F.when(ok, F.col("source")))),
        "earliest_job": F.to_date(F.min(F.when(ok, F.col("publication_date")))),
        "latest_job": F.to_date(F.max(F.when(ok, F.col("publication_date")))),
        "total_dead_letters": F.count_if(~ok)})
    return SV.stats_of(seen, SI.silver_jobs(V.valid_rows(checked)))


@register("stats_overview_silver", O.with_layers(
    "SELECT count(*) AS total_jobs, list_sort(list(DISTINCT lower(source))) AS sources, "
    "count(DISTINCT country) AS total_countries, "
    "(SELECT count(DISTINCT skill) FROM gold_skill) AS total_skills FROM silver", upto="gold"))
def q_stats_overview_silver(spark, sf):
    """AGG11."""
    from hirelake.operators import gold as G
    sv = L.silver(spark, sf)
    return SV.stats_overview_silver(sv, G.gold_skill_trends(sv))


@register("transform_summary", O.with_layers(
    "SELECT 'bronze_jobs' AS table_name, count(*) AS row_count FROM bronze UNION ALL "
    "SELECT 'silver_jobs', count(*) FROM silver UNION ALL "
    "SELECT 'gold_country_trends', count(*) FROM gold_country UNION ALL "
    "SELECT 'gold_skill_trends', count(*) FROM gold_skill UNION ALL "
    "SELECT 'gold_role_trends', count(*) FROM gold_role UNION ALL "
    "SELECT 'gold_time_trends', count(*) FROM gold_time", upto="gold"))
def q_transform_summary(spark, sf):
    """AGG6: every layer is stored once and its rows counted while it is written."""
    _, seen = L.written(spark, sf, {t: {"n": F.count(F.lit(1))} for t in ["bronze_jobs", "silver_jobs", *L.GOLD]},
                        {"candidate_required_location", "tags"})
    return spark.createDataFrame([(t, m["n"]) for t, m in seen.items()], "table_name STRING, row_count LONG")


from hirelake.plans import catalog_match  # noqa: E402,F401
from hirelake.plans import catalog_more  # noqa: E402,F401
from hirelake.plans import catalog_sources  # noqa: E402,F401
from hirelake.plans import catalog_jobs  # noqa: E402,F401


@register("dl_mark_resolved", O.with_dead(
    f"SELECT d.id, TIMESTAMP '{AS_OF}' AS resolved_at FROM dead d JOIN retry r ON r.id = d.id "
    "WHERE r.retry_error IS NULL"))
def q_dl_mark_resolved(spark, sf):
    """DL4: dead letters marked resolved by one backfill pass."""
    return _after_pass(spark, sf).filter("resolved").select("id", "resolved_at")


@register("dl_increment_retry", O.with_dead(
    "SELECT d.id, d.retry_count + 1 AS retry_count FROM dead d JOIN retry r ON r.id = d.id "
    "WHERE r.retry_error IS NOT NULL"))
def q_dl_increment_retry(spark, sf):
    """DL5: dead letters still invalid after one backfill pass, one more retry counted."""
    return _after_pass(spark, sf).filter("retry_count > 0").select("id", "retry_count")
