"""Gold monthly count tables (AGG1-AGG6, AGG3, OFF2).

Each is a hash aggregation with map-side partial counts, so a hot key (one
country holding a third of all postings) is pre-reduced in every task
before the shuffle and never lands whole in one reducer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("job_count"))


def gold_country_trends(silver: DataFrame) -> DataFrame:
    """AGG1: postings per (country, month)."""
    return _count_by(silver, "country", "published_month")


def gold_skill_trends(silver: DataFrame) -> DataFrame:
    """AGG2: postings per (skill, month); tags are already lower-cased."""
    return _count_by(
        silver.select(F.explode("tags").alias("skill"), "published_month"), "skill", "published_month"
    )


def gold_skill_trends_json(silver_json_tags: DataFrame) -> DataFrame:
    """AGG3: SQL flavour over a JSON-array text column ``tags``; skill lower-cased."""
    exploded = silver_json_tags.filter(
        F.col("tags").isNotNull() & (F.size(F.from_json("tags", "array<string>")) > 0)
    ).select(F.explode(F.from_json("tags", "array<string>")).alias("skill"), "published_month")
    return _count_by(exploded.select(F.lower("skill").alias("skill"), "published_month"),
                     "skill", "published_month")


def gold_role_trends(silver: DataFrame) -> DataFrame:
    """AGG4: postings per (role, month)."""
    return _count_by(silver, "role", "published_month")


def gold_time_trends(silver: DataFrame) -> DataFrame:
    """AGG5: postings per month."""
    return _count_by(silver, "published_month")


def transform_summary(bronze: DataFrame, silver: DataFrame, gold: dict[str, DataFrame]) -> DataFrame:
    """AGG6: row count of every layer table, one row per table."""
    parts = [bronze.select(F.lit("bronze_jobs").alias("table_name"), F.count(F.lit(1)).alias("row_count")),
             silver.select(F.lit("silver_jobs").alias("table_name"), F.count(F.lit(1)).alias("row_count"))]
    for name, df in gold.items():
        parts.append(df.select(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def offline_trends(offline: DataFrame) -> dict[str, DataFrame]:
    """OFF2: the four trend tables over the offline profile (row counts)."""
    skills = offline.select(F.explode("tags").alias("skill"), "published_month").filter(
        F.col("skill").isNotNull() & (F.col("skill") != "")
    )
    return {
        "country": _count_by(offline, "country", "published_month"),
        "skill": _count_by(skills, "skill", "published_month"),
        "role": _count_by(offline, "role", "published_month"),
        "time": _count_by(offline, "published_month"),
    }
