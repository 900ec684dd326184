"""Bronze -> silver enrichment (SIL8, SIL9) and the offline source profile (OFF1).

Each builder is one ``select`` over its input: no shuffle, no UDF; the
salary struct is expanded once so its regex work is not repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.functions import enrich, fixed
from hirelake.functions.parse import normalize_tags
from hirelake.functions.text import contains_any, py_strip

SILVER_COLUMNS = [
    "job_id", "source", "title", "company_name", "category", "role", "country",
    "tags", "publication_date", "published_date", "published_month",
    "salary_min", "salary_max", "salary_currency", "seniority",
]


def silver_jobs(bronze: DataFrame, carry: list[str] = ()) -> DataFrame:
    """SIL8: one enriched row per bronze posting; ``carry``: bronze columns that are
    passed on under a ``b_`` name, for readers of both layers.

    Three stacked projections (Catalyst keeps them apart because the
    staged expressions are used several times and are not cheap): the
    salary text and the lower-cased seniority text are computed once, the
    salary value array once, then the final columns read them.
    """
    ts = F.col("publication_date")
    staged = bronze.select(
        F.col("id").alias("job_id"), "source", "title", "company_name", "category",
        enrich.normalize_role(F.col("title")).alias("role"),
        enrich.infer_country(F.col("candidate_required_location")).alias("country"),
        F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("tags"),
        ts.alias("publication_date"),
        enrich.published_date(ts).alias("published_date"),
        enrich.published_month(ts).alias("published_month"),
        enrich.salary_text(F.col("salary"), F.col("description")).alias("_stext"),
        enrich.seniority_text(F.col("title"), F.col("description")).alias("_stitle"),
        *[F.col(c).alias(f"b_{c}") for c in carry],
    )
    staged = staged.select("*", enrich.salary_is_hourly(F.col("_stext")).alias("_hourly"))
    valued = staged.select("*", enrich.salary_values(F.col("_stext"), F.col("_hourly")).alias("_vals"))
    sal = enrich.salary_from_values(F.col("_vals"), F.col("_stext"))
    return valued.select(
        "job_id", "source", "title", "company_name", "category", "role", "country",
        "tags", "publication_date", "published_date", "published_month",
        sal["salary_min"].alias("salary_min"), sal["salary_max"].alias("salary_max"),
        sal["salary_currency"].alias("salary_currency"),
        enrich.seniority_of(F.col("_stitle")).alias("seniority"),
        *[f"b_{c}" for c in carry],
    )


def silver_jobs_sql(bronze: DataFrame) -> DataFrame:
    """SIL9: the SQL flavour - raw title as role, no salary, seniority Unspecified.

    Differs from SIL8 in the country rule: a trailing comma gives ``''``.
    """
    loc = F.col("candidate_required_location")
    low = F.lower(loc)
    country = (
        F.when(loc.isNull() | (F.trim(loc) == ""), F.lit(fixed.COUNTRY_UNKNOWN))
        .when(low.contains("worldwide"), F.lit(fixed.COUNTRY_GLOBAL))
        .when(low.contains("global"), F.lit(fixed.COUNTRY_GLOBAL))
        .when(loc.contains(","), F.trim(F.element_at(F.split(loc, ",", -1), -1)))
        .otherwise(F.trim(loc))
    )
    ts = F.col("publication_date")
    return bronze.select(
        F.col("id").alias("job_id"),
        "source",
        "title",
        "company_name",
        "category",
        F.col("title").alias("role"),
        country.alias("country"),
        F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("tags"),
        ts.alias("publication_date"),
        F.to_date(ts).alias("published_date"),
        F.trunc(F.to_date(ts), "month").alias("published_month"),
        F.lit(None).cast("double").alias("salary_min"),
        F.lit(None).cast("double").alias("salary_max"),
        F.lit(None).cast("string").alias("salary_currency"),
        F.lit(fixed.SENIORITY_UNSPECIFIED).alias("seniority"),
    )


def offline_silver(raw_csv: DataFrame) -> DataFrame:
    """OFF1: the offline profile's cleansing of the CSV extract.

    Rules: id null -> 0; default title/company; null location or one naming
    worldwide/global/anywhere -> Global; seniority on the title only;
    salary = first two integers (commas removed), always USD; month text
    ``yyyy-MM`` with a fixed default; tags from list text or CSV.
    """
    title = F.coalesce(F.col("title"), F.lit(fixed.OFFLINE_DEFAULT_TITLE))
    loc = F.col("candidate_required_location")
    loc_low = F.lower(py_strip(loc))
    country = (
        F.when(loc.isNull() | (loc == ""), F.lit(fixed.COUNTRY_GLOBAL))
        .when(contains_any(loc_low, fixed.OFFLINE_GLOBAL_WORDS), F.lit(fixed.COUNTRY_GLOBAL))
        .when(loc.contains(","), py_strip(F.element_at(F.split(loc, ",", -1), -1)))
        .otherwise(py_strip(loc))
    )
    t_low = F.lower(title)
    seniority = (
        F.when(contains_any(t_low, fixed.OFFLINE_SENIOR), F.lit("Senior"))
        .when(contains_any(t_low, fixed.OFFLINE_JUNIOR), F.lit("Junior"))
        .otherwise(F.lit(fixed.OFFLINE_MID))
    )
    nums = F.regexp_extract_all(F.regexp_replace(F.lower(F.col("salary")), ",", ""), F.lit(r"(\d+)"), 1)
    has_sal = F.col("salary").isNotNull() & (F.col("salary") != "") & (F.size(nums) >= 1)
    first = F.element_at(nums, 1).cast("double")
    second = F.when(F.size(nums) >= 2, F.element_at(nums, 2).cast("double")).otherwise(first)
    pub = F.col("publication_date")
    month = F.coalesce(
        F.date_format(parse_offline_date(pub), "yyyy-MM"), F.lit(fixed.OFFLINE_DEFAULT_MONTH)
    )
    tags = F.when(
        py_strip(F.col("tags")).startswith("["),
        F.coalesce(F.from_json(F.col("tags"), "array<string>"), normalize_tags(F.col("tags"))),
    ).otherwise(normalize_tags(F.col("tags")))
    return raw_csv.select(
        F.coalesce(F.col("id").try_cast("bigint"), F.lit(0).cast("bigint")).alias("job_id"),
        title.alias("title"),
        F.coalesce(F.col("company_name"), F.lit(fixed.OFFLINE_DEFAULT_COMPANY)).alias("company_name"),
        F.col("category"),
        country.alias("country"),
        seniority.alias("seniority"),
        F.when(has_sal, first).alias("salary_min"),
        F.when(has_sal, second).alias("salary_max"),
        F.lit(fixed.OFFLINE_CURRENCY).alias("salary_currency"),
        month.alias("published_month"),
        F.lit(fixed.FALLBACK_SOURCE).alias("source"),
        tags.alias("tags"),
        title.alias("role"),
    )


def parse_offline_date(c):
    """Lenient date parse of the offline profile (null when unparseable)."""
    return F.coalesce(
        F.regexp_replace(c, ",", ".").try_cast("timestamp"),
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd")),
    )

