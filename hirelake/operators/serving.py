"""Serving queries over silver and gold: filters, top-k, salary aggregates.

Top-k queries end in ``orderBy(...).limit(n)`` which Catalyst plans as
``TakeOrderedAndProject`` (a per-partition heap, then one merge of n rows
per partition) - no full sort.  Every ordering ends in the table key so
ties are deterministic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.operators import silver as S
from hirelake.operators.strategy import broadcast_if_small, materialize


def _trend_filter(df: DataFrame, key: str, month: dt.date | str | None, text: str | None) -> DataFrame:
    if month:
        df = df.filter(F.col("published_month") == F.lit(month).cast("date"))
    if text:
        df = df.filter(F.col(key).ilike(f"%{text}%"))
    return df


def key_trends(gold: DataFrame, key: str, limit: int = 100, month=None, text: str | None = None) -> DataFrame:
    """FLT1-FLT3: newest month first, biggest count first; tie by key."""
    return (
        _trend_filter(gold, key, month, text)
        .orderBy(F.desc("published_month"), F.desc("job_count"), F.asc(key))
        .limit(limit)
    )


def time_trends(gold_time: DataFrame, limit: int = 100) -> DataFrame:
    """FLT4: oldest month first."""
    return gold_time.orderBy("published_month").limit(limit)


def jobs_enriched(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """JN1: bronze LEFT JOIN silver on id = job_id (silver columns prefixed ``s_``)."""
    s = silver.select(*[F.col(c).alias("s_" + c) for c in silver.columns])
    return bronze.join(s, bronze["id"] == s["s_job_id"], "left")


def enriched_rows(bronze: DataFrame) -> DataFrame:
    """JN1 where silver would be made from this bronze: the same rows and columns as
    ``jobs_enriched``, by one projection instead of a join of the table with itself."""
    rows = S.silver_jobs(bronze, carry=bronze.columns)
    silver = [c for c in rows.columns if not c.startswith("b_")]
    return rows.select(*[F.col(f"b_{c}").alias(c) for c in bronze.columns], *[F.col(c).alias(f"s_{c}") for c in silver])


def jobs_page_of(bronze: DataFrame, page: int = 1, page_size: int = 50, source: str | None = None,
                 seniority: str | None = None, min_salary: float | None = None) -> DataFrame:
    """FLT5 over postings whose silver columns are computed on the way: for the rows of
    the page only, unless a filter needs them before."""
    if not 1 <= page_size <= 200 or page < 1:
        raise ValueError(f"page {page} of {page_size} rows: pages start at 1 and hold 1 to 200 rows")
    order = [F.desc("publication_date"), F.asc("id")]
    df = bronze.filter(F.col("source") == source) if source else bronze
    late = seniority is not None or min_salary is not None
    if late:
        df = enriched_rows(df)
        if seniority:
            df = df.filter(F.col("s_seniority").ilike(seniority))
        if min_salary is not None:
            df = df.filter(F.col("s_salary_max") >= F.lit(float(min_salary)))
    df = df.orderBy(*order).offset((page - 1) * page_size).limit(page_size)
    return df if late else enriched_rows(df).orderBy(*order)


def jobs_page(bronze: DataFrame, silver: DataFrame, page: int = 1, page_size: int = 50,
              source: str | None = None, seniority: str | None = None,
              min_salary: float | None = None) -> DataFrame:
    """FLT5: filtered page of postings, newest first (tie: id).

    Silver-side filters make the outer join inner; Catalyst rewrites it.
    """
    if not 1 <= page_size <= 200 or page < 1:
        raise ValueError(f"page {page} of {page_size} rows: pages start at 1 and hold 1 to 200 rows")
    offset = (page - 1) * page_size
    df = jobs_enriched(bronze, silver)
    if source:
        df = df.filter(F.col("source") == source)
    if seniority:
        df = df.filter(F.col("s_seniority").ilike(seniority))
    if min_salary is not None:
        df = df.filter(F.col("s_salary_max") >= F.lit(float(min_salary)))
    out = df.orderBy(F.desc("publication_date"), F.asc("id"))
    if offset:
        out = out.offset(offset)
    return out.limit(page_size)


def jobs_page_offline(silver: DataFrame, bronze: DataFrame, source: str | None = None,
                      seniority: str | None = None, min_salary: float | None = None,
                      limit: int = 100) -> DataFrame:
    """FLT6: silver LEFT JOIN bronze, lower-cased source, either salary bound; first ``limit`` by id.

    Each silver row gives a row at least, so the page lies within its first ``limit``
    rows: these are found first, and bronze is joined to them only.
    """
    df = silver
    if source and source != "All":
        df = df.filter(F.col("source") == source.lower())
    if seniority and seniority != "All":
        df = df.filter(F.col("seniority") == seniority)
    if min_salary is not None and float(min_salary) > 0:
        m = F.lit(float(min_salary))
        df = df.filter((F.col("salary_min") >= m) | (F.col("salary_max") >= m))
    df = materialize(df.orderBy("job_id").limit(limit))
    b = bronze.select(F.col("id").alias("_bid"), F.col("url").alias("_burl"))
    b = b.join(broadcast_if_small(df.select(F.col("job_id").alias("_bid")).distinct()), "_bid", "left_semi")
    df = df.join(b, df["job_id"] == b["_bid"], "left")
    return df.select(
        F.col("job_id").alias("id"), "source", "title", "company_name", "category", "role",
        "country", "tags", "publication_date", "published_month", "salary_min", "salary_max",
        "salary_currency", "seniority", F.coalesce(F.col("_burl"), F.lit("")).alias("url"),
    ).orderBy("id").limit(limit)


def search_jobs(df: DataFrame, pattern: str) -> DataFrame:
    """FLT7: case-insensitive regex on title OR company name."""
    rx = "(?i)" + pattern
    return df.filter(F.col("title").rlike(rx) | F.col("company_name").rlike(rx))


# --- salary -----------------------------------------------------------------

def _salary_agg(df: DataFrame, key: str) -> DataFrame:
    mid = (F.col("salary_min") + F.col("salary_max")) / 2
    return df.groupBy(key).agg(
        F.avg(mid).alias("avg_salary"),
        F.min("salary_min").alias("min_salary"),
        F.max("salary_max").alias("max_salary"),
        F.count(F.lit(1)).alias("job_count"),
    )


def _paid(silver: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and the salary columns.  These are generated, so that a filter on them
    stays above: pushed down, it would read every text again for each column it names."""
    return silver.select(*keys, F.inline(F.array(F.struct("salary_min", "salary_max", "salary_currency"))))


def _with_salary(silver: DataFrame, *keys: str) -> DataFrame:
    return _paid(silver, *keys).filter(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull())


def salary_by(silver: DataFrame, key: str, currency: str = "USD", limit: int = 20,
              exclude: list[str] | None = None) -> DataFrame:
    """AGG7/AGG8: salary statistics per key in one currency, best paid first."""
    if exclude:
        silver = silver.filter(~F.col(key).isin(*exclude))
    df = _with_salary(silver, key).filter(F.col("salary_currency") == currency)
    agg = _salary_agg(df, key).orderBy(F.desc("avg_salary"), F.asc(key)).limit(limit)
    return agg.select(
        key,
        F.bround("avg_salary", 2).alias("avg_salary"),
        F.bround("min_salary", 2).alias("min_salary"),
        F.bround("max_salary", 2).alias("max_salary"),
        "job_count",
        F.lit(currency).alias("currency"),
    )


def salary_by_role(silver: DataFrame, currency: str = "USD", limit: int = 20) -> DataFrame:
    return salary_by(silver, "role", currency, limit)


def salary_by_country(silver: DataFrame, currency: str = "USD", limit: int = 20) -> DataFrame:
    return salary_by(silver, "country", currency, limit, exclude=fixed.NON_COUNTRIES)


def salary_currencies(silver: DataFrame) -> DataFrame:
    """AGG9: currencies that have a parsed salary."""
    return (
        _paid(silver).filter(F.col("salary_currency").isNotNull() & F.col("salary_min").isNotNull()
                             & (F.col("salary_currency") != ""))
        .select("salary_currency").distinct().orderBy("salary_currency")
    )


def salary_all(silver: DataFrame, key: str) -> DataFrame:
    """AGG12/AGG13: offline flavour - every currency mixed, no limit, no rounding."""
    return _salary_agg(_with_salary(silver, key), key).orderBy(F.desc("avg_salary"), F.asc(key))


# --- stats --------------------------------------------------------------------

def stats_overview(bronze: DataFrame, dead_letters: DataFrame, gold_country: DataFrame,
                   gold_skill: DataFrame) -> DataFrame:
    """AGG10: one-row statistics; the other tables enter as scalar subqueries."""
    return bronze.agg(
        F.count("id").alias("total_jobs"),
        F.sort_array(F.collect_set("source")).alias("sources"),
        F.to_date(F.min("publication_date")).alias("earliest_job"),
        F.to_date(F.max("publication_date")).alias("latest_job"),
    ).select(
        "*",
        dead_letters.agg(F.count_if(~F.col("resolved"))).scalar().alias("total_dead_letters"),
        gold_country.agg(F.count_distinct("country")).scalar().alias("total_countries"),
        gold_skill.agg(F.count_distinct("skill")).scalar().alias("total_skills"),
    )


def stats_of(seen: dict, silver: DataFrame) -> DataFrame:
    """AGG10 from metrics observed while the postings were written, and one scan of
    silver for the distinct countries and skills."""
    kinds = F.transform("tags", lambda t: F.struct(F.lit("skill").alias("kind"), t.alias("v")))
    kinds = F.concat(F.array(F.struct(F.lit("country").alias("kind"), F.col("country").alias("v"))), kinds)
    each = silver.select("country", "tags").select(F.inline(kinds)).distinct()
    return each.agg(F.count(F.when(F.col("kind") == "country", F.col("v"))).alias("total_countries"),
                    F.count(F.when(F.col("kind") == "skill", F.col("v"))).alias("total_skills")).select(
        F.lit(seen["total_jobs"]).cast("long").alias("total_jobs"),
        F.lit(list(seen["sources"] or [])).cast("array<string>").alias("sources"),
        F.lit(seen["earliest_job"]).cast("date").alias("earliest_job"), F.lit(seen["latest_job"]).cast("date").alias("latest_job"),
        F.lit(seen["total_dead_letters"]).cast("long").alias("total_dead_letters"), "total_countries", "total_skills")


def stats_overview_silver(silver: DataFrame, gold_skill: DataFrame) -> DataFrame:
    """AGG11: offline flavour from silver (lower-cased sources)."""
    return silver.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        F.sort_array(F.collect_set(F.lower("source"))).alias("sources"),
        F.count_distinct("country").alias("total_countries"),
    ).select("*", gold_skill.agg(F.count_distinct("skill")).scalar().alias("total_skills"))


# --- top-k over gold ----------------------------------------------------------

def top_by_total(gold: DataFrame, key: str, n: int = 15, exclude: list[str] | None = None) -> DataFrame:
    """TOP1-TOP5: sum of job_count per key, top n (tie: key)."""
    df = gold.filter(~F.col(key).isin(*exclude)) if exclude else gold
    return (
        df.groupBy(key).agg(F.sum("job_count").alias("total"))
        .orderBy(F.desc("total"), F.asc(key)).limit(n)
    )


def monthly_of_top(gold: DataFrame, key: str, n: int) -> DataFrame:
    """TOP6/TOP7: monthly rows of only the top-n keys.

    The top-n set has at most n rows, a proven bound, so it is broadcast
    into a left-semi join; the gold side is never shuffled.
    """
    top = top_by_total(gold, key, n).select(key)
    return gold.join(F.broadcast(top), key, "left_semi")


def role_month_matrix(gold_role: DataFrame, n: int = 15) -> DataFrame:
    """TOP8: top-min(15, n) roles x month counts in long form, missing cells 0.

    The month axis is the months present among the top roles' rows, a
    scalar subquery bounded by the calendar; each top role (at most 15)
    is exploded over it, so no join produces the grid.
    """
    top = top_by_total(gold_role, "role", min(15, n)).select("role")
    counts = gold_role.join(F.broadcast(top), "role", "left_semi")
    months = counts.agg(F.sort_array(F.collect_set("published_month"))).scalar()
    grid = top.select("role", F.explode(months).alias("published_month"))
    return (
        grid.join(counts, ["role", "published_month"], "left")
        .select("role", "published_month", F.coalesce("job_count", F.lit(0)).alias("job_count"))
    )


def role_month_table(gold_role: DataFrame, n: int = 15) -> DataFrame:
    """TOP8: the top roles' counts with a column per month, missing cells 0.

    The months come first (bounded by the calendar), so the pivot is one
    aggregation with known columns.
    """
    top = top_by_total(gold_role, "role", min(15, n)).select("role")
    counts = materialize(gold_role.join(F.broadcast(top), "role", "left_semi"))
    months = [r[0] for r in counts.select("published_month").distinct().orderBy("published_month").collect()]
    table = counts.groupBy("role").pivot("published_month", months).agg(F.sum("job_count"))
    return table.fillna(0)


def country_ranking(gold_country: DataFrame, n: int = 50) -> DataFrame:
    """TOP9: totals with 1-based rank, first n.

    The top-n totals are taken first (TakeOrderedAndProject); the rank
    window then runs over at most n rows.
    """
    totals = gold_country.groupBy("country").agg(F.sum("job_count").alias("total"))
    top = totals.orderBy(F.desc("total"), F.asc("country")).limit(n)
    w = Window.orderBy(F.desc("total"), F.asc("country"))
    return top.withColumn("rank", F.row_number().over(w))


def time_kpis(gold_time: DataFrame) -> DataFrame:
    """TOP10: total, peak month and its count (earliest month wins ties)."""
    peak_key = F.struct(F.col("job_count"), -F.unix_date("published_month"))
    return gold_time.agg(
        F.sum("job_count").alias("total_jobs"),
        F.max_by("published_month", peak_key).alias("peak_month"),
        F.max("job_count").alias("peak_count"),
    )


def salary_kpis(salary_roles: DataFrame) -> DataFrame:
    """TOP11: mean of role averages, top role and its average, jobs analysed."""
    top_key = F.struct(-F.col("avg_salary"), F.col("role"))
    return salary_roles.agg(
        F.avg("avg_salary").alias("mean_avg_salary"),
        F.min_by("role", top_key).alias("top_role"),
        F.max("avg_salary").alias("top_avg_salary"),
        F.sum("job_count").alias("jobs_analysed"),
    )


def skill_options(gold_skill: DataFrame, first: int | None = None) -> DataFrame:
    """TOP12: sorted distinct skills, of all trend rows or of the ``first`` ones."""
    rows = gold_skill if first is None else key_trends(gold_skill, "skill", first)
    return rows.select("skill").distinct().orderBy("skill")
