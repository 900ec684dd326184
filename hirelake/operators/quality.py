"""Data-quality audits (DQ1-DQ8).

Every check is one aggregation pass: fill rates and null counts are
``count_if`` columns of a single ``agg``; the long (field, value) shape is
produced with ``stack`` on the one-row result, not by re-scanning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.functions.text import py_strip

# --- fixed values: columns under not-null / unique / accepted-values tests --
BRONZE_NOT_NULL = ["id", "source", "url", "title", "company_name", "publication_date", "ingested_at"]
SILVER_NOT_NULL = ["job_id", "source", "title", "company_name", "role", "country",
                   "publication_date", "published_date", "published_month"]
GOLD_NOT_NULL = {
    "gold_country_trends": ["country", "published_month", "job_count"],
    "gold_skill_trends": ["skill", "published_month", "job_count"],
    "gold_role_trends": ["role", "published_month", "job_count"],
    "gold_time_trends": ["published_month", "job_count"],
}


def dq_rows(enriched: DataFrame, sample: int | None = None) -> DataFrame:
    """Rows audited: postings with silver columns, newest first; ``sample`` None = all."""
    rows = enriched.select(
        "id", "source", "title", "company_name", "url", "category", "tags",
        F.col("candidate_required_location").alias("country"),
        F.col("s_salary_min").alias("salary_min"), F.col("s_salary_max").alias("salary_max"),
        F.col("s_seniority").alias("seniority"), "publication_date",
    )
    if sample is not None:
        rows = rows.orderBy(F.desc("publication_date"), F.asc("id")).limit(sample)
    return rows


def _filled_text(c: Column, empty: list[str]) -> Column:
    """``str(x).strip().lower() not in empty`` (null renders as 'none')."""
    txt = F.coalesce(F.lower(py_strip(c)), F.lit("none"))
    return ~txt.isin(*empty)


def _pct(cond: Column) -> Column:
    return F.count_if(cond).cast("double") * F.lit(100.0).cast("double") / F.count(F.lit(1))


def fill_rates(rows: DataFrame) -> DataFrame:
    """DQ1: analysed rows, location / salary / tags fill %, average tags."""
    return rows.agg(
        F.count(F.lit(1)).alias("analyzed"),
        _pct(_filled_text(F.col("country"), fixed.DQ_EMPTY_LOCATIONS)).alias("location_fill_rate"),
        _pct(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull()).alias("salary_fill_rate"),
        _pct(F.coalesce(F.size("tags"), F.lit(0)) > 0).alias("tags_fill_rate"),
        F.avg(F.coalesce(F.size("tags"), F.lit(0))).alias("avg_tags"),
    )


def completeness(rows: DataFrame) -> DataFrame:
    """DQ2: six (field, completeness %) rows from one aggregation."""
    agg = rows.agg(
        _pct(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull()).alias("a"),
        _pct(_filled_text(F.col("country"), fixed.DQ_EMPTY_LOCATIONS)).alias("b"),
        _pct(F.coalesce(F.size("tags"), F.lit(0)) > 0).alias("c"),
        _pct(F.col("company_name").isNotNull()).alias("d"),
        _pct(F.col("url").isNotNull()).alias("e"),
        _pct(_filled_text(F.col("category"), ["none", "nan", "unknown", ""])).alias("f"),
    )
    return agg.select(F.expr(
        "stack(6, 'Salary Info', a, 'Country / Location', b, 'Skill Tags', c, "
        "'Company Name', d, 'Job URL', e, 'Job Category', f) AS (field, completeness_pct)"
    ))


def value_counts(rows: DataFrame, col: str) -> DataFrame:
    """DQ3/DQ4: counts per value, nulls dropped, biggest first (tie: value)."""
    return (
        rows.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(col))
    )


def salary_points(rows: DataFrame) -> DataFrame:
    """DQ5: rows with both salary bounds."""
    return rows.filter(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull()).select(
        "salary_min", "salary_max", "seniority", "title", "company_name")


def not_null_report(tables: dict[str, DataFrame], columns: dict[str, list[str]]) -> DataFrame:
    """DQ6: null count of each tested column; one aggregation per table."""
    parts = []
    for name, df in tables.items():
        cols = columns[name]
        agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stack = "stack({n}, {pairs}) AS (column_name, null_count)".format(
            n=len(cols), pairs=", ".join(f"'{c}', `{c}`" for c in cols))
        parts.append(agg.select(F.lit(name).alias("table_name"), F.expr(stack)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def unique_report(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """DQ7: number of key values occurring more than once."""
    parts = []
    for name, (df, key) in tables.items():
        dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
        parts.append(dup.agg(F.count(F.lit(1)).alias("duplicate_keys")).select(
            F.lit(name).alias("table_name"), F.lit(key).alias("column_name"), "duplicate_keys"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def accepted_values_report(tables: dict[str, DataFrame], col: str = "source",
                           accepted: list[str] | None = None) -> DataFrame:
    """DQ8: rows whose value is outside the accepted list (nulls not counted)."""
    accepted = accepted or fixed.ACCEPTED_SOURCES
    parts = [
        df.agg(F.count_if(F.col(col).isNotNull() & ~F.col(col).isin(*accepted)).alias("failing_rows"))
        .select(F.lit(name).alias("table_name"), F.lit(col).alias("column_name"), "failing_rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
