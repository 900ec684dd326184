"""Layer counts and end-to-end runs (the reference's transformation and e2e cases)."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelake.operators import gold as G
from hirelake.operators import serving as SV
from hirelake.operators import silver as S
from hirelake.operators import validate as V
from hirelake.plans import jobs as J
from hirelake.plans import sinks
from tests.test_validation import RAW, rec


def _bronze(spark, rows):
    return V.valid_rows(V.validate(spark.createDataFrame(rows, RAW)))


def test_transformation_counts(spark):
    bronze = _bronze(spark, [
        rec(id="1", candidate_required_location="Remote, USA", tags="python, sql"),
        rec(id="2", url="https://remotive.com/jobs/2", candidate_required_location="Worldwide",
            tags="['dbt', 'sql']", _pos=1),
    ])
    silver = S.silver_jobs(bronze)
    assert silver.count() == 2
    assert G.gold_country_trends(silver).count() >= 2
    assert G.gold_skill_trends(silver).count() >= 3
    assert G.gold_time_trends(silver).count() == 1
    countries = {r["country"] for r in silver.collect()}
    assert countries == {"USA", "Global"}


def test_end_to_end_one_month_two_roles(spark, tmp_path):
    raw = spark.createDataFrame([
        rec(id="201", title="Data Engineer", candidate_required_location="Berlin, Germany"),
        rec(id="202", url="https://remotive.com/jobs/202", title="ML Engineer",
            candidate_required_location="Worldwide", _pos=1),
        rec(id="203", url="bad", _pos=2),
    ], RAW).drop("_keys")
    t = J.Tables(str(tmp_path / "tables"))
    summary = J.run_all(spark, raw, t, now=F.lit("2026-07-01").cast("timestamp")).first()
    assert (summary["fetched"], summary["valid"], summary["invalid"]) == (3, 2, 1)
    assert summary["gold_time_trends_rows"] == 1 and summary["gold_role_trends_rows"] == 2
    assert summary["recovered"] == 1
    assert sinks.read_table(spark, t.path("bronze_jobs")).count() == 3


def test_upsert_keeps_first_ingested_at_and_last_value(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, "b", 10)], "id INT, v STRING, ingested_at INT")
    new = spark.createDataFrame([(1, "a1", 20, 1), (1, "a2", 30, 2), (3, "c", 40, 3)],
                                "id INT, v STRING, ingested_at INT, seq INT")
    got = {r["id"]: (r["v"], r["ingested_at"]) for r in
           sinks.upsert(old, new, "id", "seq", keep_first=["ingested_at"]).collect()}
    assert got == {1: ("a2", 10), 2: ("b", 10), 3: ("c", 40)}
    twice = sinks.upsert(sinks.upsert(old, new, "id", "seq", ["ingested_at"]), new, "id", "seq", ["ingested_at"])
    assert {r["id"]: (r["v"], r["ingested_at"]) for r in twice.collect()} == got


def test_trend_filters_and_topk(spark):
    gold = spark.createDataFrame([
        ("Canada", "2026-06-01", 3), ("Germany", "2026-06-01", 5), ("Canada", "2026-05-01", 9),
    ], "country STRING, published_month STRING, job_count LONG").withColumn(
        "published_month", F.col("published_month").cast("date"))
    assert [r["country"] for r in SV.key_trends(gold, "country", text="can").collect()] == ["Canada", "Canada"]
    assert SV.key_trends(gold, "country", text="nowhere").count() == 0
    top = SV.top_by_total(gold, "country", 1).first()
    assert (top["country"], top["total"]) == ("Canada", 12)
    kpi = SV.time_kpis(gold.groupBy("published_month").agg(F.sum("job_count").alias("job_count"))).first()
    assert kpi["total_jobs"] == 17 and str(kpi["peak_month"]) == "2026-05-01"
