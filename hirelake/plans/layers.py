"""Layer builders over the driver's tables: raw -> bronze -> silver -> gold.

These are lazy DataFrames; ``written`` stores each layer once and collects counts
on the way, for reports that read several of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.operators import gold as G
from hirelake.operators import silver as S
from hirelake.operators import serving as SV
from hirelake.operators import validate as V
from hirelake.operators.strategy import observed
from hirelake.sources import landing as LG
from hirelake.sources import testdata


# What validation reads of the joined fields, and each gold table beyond that.
_CHECKED = {"title", "company_name"}
_GOLD_FIELDS = {"country": {"candidate_required_location"}, "skill": {"tags"}, "role": set(), "time": set()}


def raw(spark: SparkSession, sf_dir: str, fields: set[str] | None = None) -> DataFrame:
    """Raw postings; with ``fields``, only those joined fields are filled."""
    return testdata.raw_postings(spark, sf_dir, fields)


def validated(spark: SparkSession, sf_dir: str, run_source: str = fixed.DEFAULT_SOURCE,
              fields: set[str] | None = None) -> DataFrame:
    return V.validate(raw(spark, sf_dir, None if fields is None else fields | _CHECKED), run_source)


def bronze(spark: SparkSession, sf_dir: str, fields: set[str] | None = None) -> DataFrame:
    return V.valid_rows(validated(spark, sf_dir, fields=fields))


def bronze_dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze dealt over tasks by ranges of the posting's place, which its id is made of; where
    documents can be broadcast, descriptions come after that and are not shuffled."""
    rows, describe = testdata.described_late(spark, sf_dir)
    return V.valid_rows(V.validate(LG._dealt(rows, describe, "_pos"), fixed.DEFAULT_SOURCE))


def silver(spark: SparkSession, sf_dir: str, fields: set[str] | None = None) -> DataFrame:
    return S.silver_jobs(bronze(spark, sf_dir, fields))


def gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A gold table; tables that it does not count are not read."""
    sv = silver(spark, sf_dir, _GOLD_FIELDS[name])
    return {
        "country": G.gold_country_trends,
        "skill": G.gold_skill_trends,
        "role": G.gold_role_trends,
        "time": G.gold_time_trends,
    }[name](sv)


GOLD = {"gold_country_trends": G.gold_country_trends, "gold_skill_trends": G.gold_skill_trends,
        "gold_role_trends": G.gold_role_trends, "gold_time_trends": G.gold_time_trends}


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows with their silver columns (``s_``), derived once."""
    return SV.enriched_rows(bronze(spark, sf_dir))


def written(spark: SparkSession, sf_dir: str, metrics: dict[str, dict[str, Column]],
            fields: set[str] | None = None) -> tuple[dict[str, DataFrame], dict[str, dict]]:
    """Bronze, silver and the gold tables, each stored once from the one before, and
    per layer the ``metrics`` observed while it was written."""
    frames, seen = {}, {}
    frames["bronze_jobs"], seen["bronze_jobs"] = observed(bronze(spark, sf_dir, fields), metrics["bronze_jobs"])
    frames["silver_jobs"], seen["silver_jobs"] = observed(S.silver_jobs(frames["bronze_jobs"]), metrics["silver_jobs"])
    for name, build in GOLD.items():
        if name in metrics:
            frames[name], seen[name] = observed(build(frames["silver_jobs"]), metrics[name])
    return frames, seen
