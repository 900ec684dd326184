"""Registered job-page, search, data-quality, flavour and scalar-operator queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelake.functions import enrich, fixed
from hirelake.functions import parse as P
from hirelake.functions import terms as T
from hirelake.functions.text import clean_text
from hirelake.operators import gold as G
from hirelake.operators import quality as Q
from hirelake.operators import serving as SV
from hirelake.operators import silver as S
from hirelake.operators import validate as V
from hirelake.operators.strategy import materialize
from hirelake.plans import layers as L
from hirelake.plans import oracle as O
from hirelake.plans.catalog import register
from hirelake.plans.paging import Pages
from hirelake.session import scratch_path


def _enriched(spark, sf):
    return L.enriched(spark, sf)


# --- joins, pages, search (JN1, FLT5-FLT7) ------------------------------------------

@register("jobs_enriched", O.with_layers(
    "SELECT b.id, b.source, b.title, s.job_id AS s_job_id, s.role AS s_role, s.country AS s_country, "
    "s.seniority AS s_seniority, s.salary_min AS s_salary_min, s.salary_max AS s_salary_max "
    "FROM bronze b LEFT JOIN silver s ON s.job_id = b.id"))
def q_jobs_enriched(spark, sf):
    """JN1: bronze LEFT JOIN silver, both stored."""
    bronze = materialize(L.bronze(spark, sf))
    return SV.jobs_enriched(bronze, materialize(S.silver_jobs(bronze))).select("id", "source", "title", "s_job_id", "s_role", "s_country",
                                        "s_seniority", "s_salary_min", "s_salary_max")


_PAGE_COLS = "id, source, title, company_name, publication_date, s_seniority, s_salary_min, s_salary_max"


def _page_sql(where: str, offset: int, limit: int) -> str:
    return O.with_layers(
        f"SELECT {_PAGE_COLS} FROM (SELECT b.*, s.seniority AS s_seniority, s.salary_min AS s_salary_min, "
        f"s.salary_max AS s_salary_max FROM bronze b LEFT JOIN silver s ON s.job_id = b.id) {where} "
        f"ORDER BY publication_date DESC, id LIMIT {limit} OFFSET {offset}")


@register("jobs_page", _page_sql("", 0, 50))
def q_jobs_page(spark, sf):
    """FLT5, first page of 50."""
    return SV.jobs_page_of(L.bronze(spark, sf)).select(*_PAGE_COLS.split(", "))


_DEEP = 200  # the page of the deep query


@register("jobs_page_deep", _page_sql("", 20 * (_DEEP - 1), 20))
def q_jobs_page_deep(spark, sf):
    """FLT5: a late page of stored postings, read from the files that hold it."""
    pages = Pages(spark, scratch_path(spark, "job-pages"))
    pages.build(_enriched(spark, sf).select(*_PAGE_COLS.split(", ")), [("publication_date", True), ("id", False)])
    return pages.page(_DEEP, 20)


@register("jobs_page_filtered", _page_sql(
    "WHERE source = 'remoteok' AND s_seniority ILIKE 'senior' AND s_salary_max >= 100000", 50, 50))
def q_jobs_page_filtered(spark, sf):
    """FLT5 with source, seniority and salary filters, page 2."""
    return SV.jobs_page_of(L.bronze(spark, sf), page=2, page_size=50, source="remoteok", seniority="senior", min_salary=100000).select(*_PAGE_COLS.split(", "))


def _offline_page_sql(where: str) -> str:
    return O.with_layers(
        "SELECT s.job_id AS id, s.source, s.title, s.company_name, s.category, s.role, s.country, s.tags, "
        "s.publication_date, s.published_month, s.salary_min, s.salary_max, s.salary_currency, s.seniority, "
        f"coalesce(b.url, '') AS url FROM silver s LEFT JOIN bronze b ON s.job_id = b.id {where} "
        "ORDER BY s.job_id LIMIT 100")


@register("jobs_page_offline", _offline_page_sql(
    "WHERE s.seniority = 'Senior' AND (s.salary_min >= 120000 OR s.salary_max >= 120000)"))
def q_jobs_page_offline(spark, sf):
    """FLT6 with seniority and salary filters."""
    return SV.jobs_page_offline(L.silver(spark, sf), L.bronze(spark, sf), seniority="Senior", min_salary=120000)


@register("search_jobs", O.with_layers(
    "SELECT id, title, company_name FROM bronze WHERE regexp_matches(title, '(?i)ring|widget$') "
    "OR regexp_matches(company_name, '(?i)ring|widget$')"))
def q_search_jobs(spark, sf):
    """FLT7: regex search over titles and companies."""
    return SV.search_jobs(L.bronze(spark, sf), "ring|widget$").select("id", "title", "company_name")


# --- data quality (DQ1-DQ8) ------------------------------------------------------------

_DQ_ROWS = ("(SELECT b.id, b.source, b.title, b.company_name, b.url, b.category, b.tags, "
            "b.candidate_required_location AS country, s.salary_min, s.salary_max, s.seniority, b.publication_date "
            "FROM bronze b LEFT JOIN silver s ON s.job_id = b.id)")
_LOC_FILLED = "coalesce(lower(trim(country)), 'none') NOT IN ('unknown', 'none', 'nan', '')"
_CAT_FILLED = "coalesce(lower(trim(category)), 'none') NOT IN ('none', 'nan', 'unknown', '')"


def _pct(cond: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {cond}) AS DOUBLE) * 100.0 / count(*)"


@register("dq_fill_rates", O.with_layers(
    f"SELECT count(*) AS analyzed, {_pct(_LOC_FILLED)} AS location_fill_rate, "
    f"{_pct('salary_min IS NOT NULL AND salary_max IS NOT NULL')} AS salary_fill_rate, "
    f"{_pct('coalesce(len(tags), 0) > 0')} AS tags_fill_rate, avg(coalesce(len(tags), 0)) AS avg_tags "
    f"FROM {_DQ_ROWS}"))
def q_dq_fill_rates(spark, sf):
    """DQ1 over every posting."""
    return Q.fill_rates(Q.dq_rows(_enriched(spark, sf)))


@register("dq_completeness", O.with_layers(
    "SELECT field, completeness_pct FROM (SELECT "
    f"{_pct('salary_min IS NOT NULL AND salary_max IS NOT NULL')} AS a, {_pct(_LOC_FILLED)} AS b, "
    f"{_pct('coalesce(len(tags), 0) > 0')} AS c, {_pct('company_name IS NOT NULL')} AS d, "
    f"{_pct('url IS NOT NULL')} AS e, {_pct(_CAT_FILLED)} AS f FROM {_DQ_ROWS}) "
    "UNPIVOT (completeness_pct FOR field IN (a AS 'Salary Info', b AS 'Country / Location', c AS 'Skill Tags', "
    "d AS 'Company Name', e AS 'Job URL', f AS 'Job Category'))"))
def q_dq_completeness(spark, sf):
    """DQ2."""
    return Q.completeness(Q.dq_rows(_enriched(spark, sf)))


@register("dq_source_counts", O.with_layers(
    f"SELECT source, count(*) AS count FROM {_DQ_ROWS} WHERE source IS NOT NULL GROUP BY source"))
def q_dq_source_counts(spark, sf):
    """DQ3."""
    return Q.value_counts(Q.dq_rows(_enriched(spark, sf)), "source")


@register("dq_seniority_counts", O.with_layers(
    f"SELECT seniority, count(*) AS count FROM {_DQ_ROWS} WHERE seniority IS NOT NULL GROUP BY seniority"))
def q_dq_seniority_counts(spark, sf):
    """DQ4."""
    return Q.value_counts(Q.dq_rows(_enriched(spark, sf)), "seniority")


@register("dq_salary_points", O.with_layers(
    f"SELECT salary_min, salary_max, seniority, title, company_name FROM {_DQ_ROWS} "
    "WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL"))
def q_dq_salary_points(spark, sf):
    """DQ5."""
    return Q.salary_points(Q.dq_rows(_enriched(spark, sf)))


def _nn_sql(table: str, cols: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count "
        f"FROM {src}" for c, src in [(c, _GOLD_SRC.get(table, table.replace('_jobs', ''))) for c in cols])


_GOLD_SRC = {"bronze_jobs": "bronze", "silver_jobs": "silver", "gold_country_trends": "gold_country",
             "gold_skill_trends": "gold_skill", "gold_role_trends": "gold_role", "gold_time_trends": "gold_time"}


_NARROW = {"candidate_required_location", "tags"}  # what the checked columns are made of


@register("check_not_null", O.with_layers(" UNION ALL ".join(
    [_nn_sql("bronze_jobs", Q.BRONZE_NOT_NULL), _nn_sql("silver_jobs", Q.SILVER_NOT_NULL)]
    + [_nn_sql(t, c) for t, c in Q.GOLD_NOT_NULL.items()]), upto="gold"))
def q_check_not_null(spark, sf):
    """DQ6."""
    cols = {"bronze_jobs": Q.BRONZE_NOT_NULL, "silver_jobs": Q.SILVER_NOT_NULL, **Q.GOLD_NOT_NULL}
    _, seen = L.written(spark, sf, {t: {c: F.count_if(F.col(c).isNull()) for c in cs} for t, cs in cols.items()}, _NARROW)
    return spark.createDataFrame([(t, c, n) for t, m in seen.items() for c, n in m.items()],
                                 "table_name STRING, column_name STRING, null_count LONG")


@register("check_unique", O.with_layers(
    "SELECT 'bronze_jobs' AS table_name, 'id' AS column_name, (SELECT count(*) FROM (SELECT id FROM bronze "
    "GROUP BY id HAVING count(*) > 1)) AS duplicate_keys UNION ALL "
    "SELECT 'silver_jobs', 'job_id', (SELECT count(*) FROM (SELECT job_id FROM silver GROUP BY job_id "
    "HAVING count(*) > 1)) UNION ALL "
    "SELECT 'gold_time_trends', 'published_month', (SELECT count(*) FROM (SELECT published_month FROM gold_time "
    "GROUP BY published_month HAVING count(*) > 1))", upto="gold"))
def q_check_unique(spark, sf):
    """DQ7."""
    none = {t: {"n": F.count(F.lit(1))} for t in ("bronze_jobs", "silver_jobs", "gold_time_trends")}
    frames, _ = L.written(spark, sf, none, _NARROW)
    return Q.unique_report({"bronze_jobs": (frames["bronze_jobs"], "id"), "silver_jobs": (frames["silver_jobs"], "job_id"),
                            "gold_time_trends": (frames["gold_time_trends"], "published_month")})


@register("check_accepted_values", O.with_layers(
    "SELECT 'bronze_jobs' AS table_name, 'source' AS column_name, count(*) FILTER (WHERE source IS NOT NULL AND "
    f"source NOT IN ({O._sql_list(fixed.ACCEPTED_SOURCES)})) AS failing_rows FROM bronze UNION ALL "
    "SELECT 'silver_jobs', 'source', count(*) FILTER (WHERE source IS NOT NULL AND "
    f"source NOT IN ({O._sql_list(fixed.ACCEPTED_SOURCES)})) FROM silver"))
def q_check_accepted_values(spark, sf):
    """DQ8."""
    bad = F.count_if(F.col("source").isNotNull() & ~F.col("source").isin(*fixed.ACCEPTED_SOURCES))
    _, seen = L.written(spark, sf, {"bronze_jobs": {"n": bad}, "silver_jobs": {"n": bad}}, _NARROW)
    return spark.createDataFrame([(t, "source", m["n"]) for t, m in seen.items()],
                                 "table_name STRING, column_name STRING, failing_rows LONG")


# --- SQL flavour, offline flavour (SIL9, AGG3, OFF1, OFF2) ----------------------------

_SIL9_SQL = (
    "SELECT id AS job_id, source, title, company_name, category, title AS role, "
    "CASE WHEN candidate_required_location IS NULL OR trim(candidate_required_location) = '' THEN 'Unknown' "
    "WHEN contains(lower(candidate_required_location), 'worldwide') THEN 'Global' "
    "WHEN contains(lower(candidate_required_location), 'global') THEN 'Global' "
    "WHEN contains(candidate_required_location, ',') THEN trim(string_split(candidate_required_location, ',')[-1]) "
    "ELSE trim(candidate_required_location) END AS country, tags, publication_date, "
    "CAST(publication_date AS DATE) AS published_date, CAST(date_trunc('month', publication_date) AS DATE) "
    "AS published_month, CAST(NULL AS DOUBLE) AS salary_min, CAST(NULL AS DOUBLE) AS salary_max, "
    "CAST(NULL AS VARCHAR) AS salary_currency, 'Unspecified' AS seniority FROM bronze")


@register("silver_jobs_sql", O.with_layers(_SIL9_SQL, upto="bronze"))
def q_silver_jobs_sql(spark, sf):
    """SIL9."""
    return S.silver_jobs_sql(L.bronze(spark, sf))


@register("gold_skill_trends_json", O.with_layers(
    "SELECT lower(skill) AS skill, published_month, count(*) AS job_count FROM ("
    "SELECT unnest(tags) AS skill, published_month FROM (" + _SIL9_SQL + ") WHERE len(tags) > 0) "
    "GROUP BY lower(skill), published_month", upto="bronze"))
def q_gold_skill_trends_json(spark, sf):
    """AGG3: skills unnested from a JSON-array text column."""
    sv = S.silver_jobs_sql(L.bronze(spark, sf)).withColumn("tags", F.to_json("tags"))
    return G.gold_skill_trends_json(sv)


# --- scalar operators, one key each (VAL1-VAL7, SIL1-SIL7, SRC6, SRC7) ----------------

@register("clean_text", O.with_layers(
    "SELECT id, company_logo, category, job_type, candidate_required_location, salary FROM validated",
    upto="validated"))
def q_clean_text(spark, sf):
    """VAL1 on the optional text fields of every raw posting."""
    return L.validated(spark, sf).select("id", "company_logo", "category", "job_type",
                                         "candidate_required_location", "salary")


def _raw_rule_sql(expr: str) -> str:
    return O.with_layers(f"SELECT _pos, {expr} AS rule_error FROM raw", upto="validated")


@register("rule_required_text", _raw_rule_sql(
    f"CASE WHEN nullif(regexp_replace(title, '^\\s+|\\s+$', '', 'g'), '') IS NULL THEN '{fixed.MSG_BLANK}' END"))
def q_rule_required_text(spark, sf):
    """VAL2 on titles."""
    raw = L.raw(spark, sf)
    return raw.select("_pos", V.rule_required_text(raw, "title").alias("rule_error"))


@register("rule_id", _raw_rule_sql(
    f"CASE WHEN TRY_CAST(id AS BIGINT) <= 0 THEN '{fixed.MSG_GT_ZERO}' END"))
def q_rule_id(spark, sf):
    """VAL3."""
    raw = L.raw(spark, sf)
    return raw.select("_pos", V.rule_id(raw).alias("rule_error"))


@register("rule_url", _raw_rule_sql(
    f"CASE WHEN url = '' THEN '{fixed.MSG_STR_SHORT}' WHEN NOT regexp_matches(url, '^https?://') "
    f"THEN '{fixed.MSG_URL_PREFIX}' END"))
def q_rule_url(spark, sf):
    """VAL4."""
    raw = L.raw(spark, sf)
    return raw.select("_pos", V.rule_url(raw).alias("rule_error"))


@register("normalize_tags", O.with_layers(
    "SELECT _pos, list_filter(_tag_list, lambda x, i: list_position(_tag_list, x) = i) AS tags FROM validated",
    upto="validated"))
def q_normalize_tags(spark, sf):
    """VAL5 on list-text, CSV and null tags."""
    raw = L.raw(spark, sf)
    return raw.select("_pos", P.normalize_tags(F.col("tags")).alias("tags"))


@register("normalize_pubdate", O.with_layers("SELECT _pos, publication_date FROM validated", upto="validated"))
def q_normalize_pubdate(spark, sf):
    """VAL6."""
    raw = L.raw(spark, sf)
    return raw.select("_pos", P.parse_iso_timestamp(F.col("publication_date")).alias("publication_date"))


@register("default_source", O.with_layers(
    "SELECT _pos, 'all' AS source, " + O.rules_sql("id", "url", "title", "company_name", "'all'")
    + " AS error_message FROM raw", upto="validated"))
def q_default_source(spark, sf):
    """VAL7: records without a source key take the run's source ('all')."""
    v = V.validate(L.raw(spark, sf).drop("source"), "all")
    return v.select("_pos", "source", "error_message")


def _bronze_proj_sql(cols: str) -> str:
    return O.with_layers(f"SELECT job_id AS id, {cols} FROM silver")


@register("normalize_role", _bronze_proj_sql("role"))
def q_normalize_role(spark, sf):
    """SIL1."""
    return L.bronze(spark, sf).select("id", enrich.normalize_role(F.col("title")).alias("role"))


@register("infer_country", _bronze_proj_sql("country"))
def q_infer_country(spark, sf):
    """SIL2."""
    return L.bronze(spark, sf).select("id", enrich.infer_country(F.col("candidate_required_location")).alias("country"))


@register("salary_currency", O.with_layers(
    "SELECT id, CASE WHEN _stext IS NULL THEN NULL WHEN contains(_stext, '€') OR contains(upper(_stext), 'EUR') THEN 'EUR' "
    "WHEN contains(_stext, '£') OR contains(upper(_stext), 'GBP') THEN 'GBP' ELSE 'USD' END AS currency FROM sal"))
def q_salary_currency(spark, sf):
    """SIL3 on the salary text (or description head)."""
    t = enrich.salary_text(F.col("salary"), F.col("description"))
    return L.bronze(spark, sf).select("id", F.when(t.isNotNull(), enrich.salary_currency_of(t)).alias("currency"))


@register("salary_is_hourly", O.with_layers("SELECT id, _hourly AS hourly FROM sal2"))
def q_salary_is_hourly(spark, sf):
    """SIL4."""
    t = enrich.salary_text(F.col("salary"), F.col("description"))
    return L.bronze(spark, sf).select("id", enrich.salary_is_hourly(t).alias("hourly"))


@register("parse_salary", _bronze_proj_sql("salary_min, salary_max, salary_currency"))
def q_parse_salary(spark, sf):
    """SIL5."""
    return L.bronze(spark, sf).select(
        "id", enrich.parse_salary(F.col("salary"), F.col("description")).alias("s")).select(
        "id", "s.salary_min", "s.salary_max", "s.salary_currency")


@register("classify_seniority", _bronze_proj_sql("seniority"))
def q_classify_seniority(spark, sf):
    """SIL6 (title + whole description)."""
    return L.bronze(spark, sf).select(
        "id", enrich.classify_seniority(F.col("title"), F.col("description")).alias("seniority"))


@register("date_grains", _bronze_proj_sql("published_date, published_month"))
def q_date_grains(spark, sf):
    """SIL7."""
    ts = F.col("publication_date")
    return L.bronze(spark, sf).select(
        "id", enrich.published_date(ts).alias("published_date"), enrich.published_month(ts).alias("published_month"))


_KW_RX = "\\b(" + "|".join(fixed.SKILL_KEYWORDS) + ")\\b"


@register("extract_skill_keywords", O.with_resumes(
    "SELECT resume_id, list_filter(kw, lambda x, i: list_position(kw, x) = i) AS keywords FROM ("
    "SELECT doc_id AS resume_id, flatten(list_transform(string_split(text, '.'), lambda q: "
    f"regexp_extract_all({O._ascii_words('lower(q)')}, '{_KW_RX}', 1))) AS kw FROM resume_docs)"))
def q_extract_skill_keywords(spark, sf):
    """SRC6: qualification keywords, qualifications = sentences of each résumé."""
    from hirelake.sources import testdata as TD
    r = TD.resumes(spark, sf)
    quals = F.split(F.col("resume_text"), "[.]", -1)
    return r.select("resume_id", T.qualification_keywords(quals).alias("keywords"))


@register("stable_id", O.with_layers(
    "SELECT id, (('0x' || substr(md5('remoteok:' || CAST(id AS VARCHAR)), 1, 15))::BIGINT % 1000000000) "
    "+ 500000000 AS remoteok_id, (('0x' || substr(md5('jsearch:' || CAST(id AS VARCHAR)), 1, 15))::BIGINT "
    "% 1000000000) + 2500000000 AS jsearch_id FROM bronze"))
def q_stable_id(spark, sf):
    """SRC7: namespaced reproducible ids."""
    return L.bronze(spark, sf).select(
        "id",
        T.stable_id("remoteok", F.col("id"), fixed.ID_OFFSET_REMOTEOK).alias("remoteok_id"),
        T.stable_id("jsearch", F.col("id"), fixed.ID_OFFSET_JSEARCH).alias("jsearch_id"),
    )
