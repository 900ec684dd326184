"""Rows that a query needs once are made once, and only those it needs are joined."""

from __future__ import annotations

import datetime as dt

from hirelake.operators import changes as C
from hirelake.operators import serving as SV
from hirelake.operators import silver as S
from hirelake.plans import catalog_jobs
from hirelake.plans import layers as L
from hirelake.plans.paging import Pages
from hirelake.session import scratch_path

BRONZE = ("id LONG, source STRING, title STRING, company_name STRING, category STRING, candidate_required_location STRING, "
          "tags ARRAY<STRING>, publication_date TIMESTAMP, salary STRING, description STRING, url STRING")


def _bronze(spark, n=40):
    return spark.createDataFrame(
        [(i % 35, "remoteok", "Senior engineer", "acme", None, "Peru", ["sql"], dt.datetime(2026, 1, 1 + i % 20),
          "$130k" if i % 2 else "$50k", f"text {i % 35}", f"https://example.com/{i % 35}") for i in range(n)], BRONZE)


def _counted(df, seen):
    """``df``, each of its rows counted whenever it is made."""
    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema)


def test_pages_make_their_rows_once(spark):
    """dealing by range reads its input twice, so the rows are stored before."""
    seen = spark.sparkContext.accumulator(0)
    rows = _counted(spark.range(1000).selectExpr("id", "id % 7 AS x").repartition(4), seen)
    pages = Pages(spark, scratch_path(spark, "pages-once"))
    pages.build(rows, [("x", True), ("id", False)], 100)
    assert seen.value == 1000
    assert [r.id for r in pages.page(1, 3).collect()] == [6, 13, 20]


def test_snapshot_makes_each_table_from_the_one_before(spark, monkeypatch):
    """postings are derived and parsed once for the three tables."""
    made = []
    monkeypatch.setattr(L, "bronze", lambda spark, sf, fields=None: made.append(1) or _bronze(spark))
    got = {r.table_name: (r.src_rows, r.dst_rows) for r in catalog_jobs.q_snapshot_copy(spark, "unused").collect()}
    assert len(made) == 1
    assert got == {"bronze_jobs": (40, 40), "silver_jobs": (40, 40), "gold_country_trends": (1, 1)}


def test_bookmark_lookup_joins_bookmarked_postings_only(spark):
    """the texts of other postings stay out of the join."""
    bronze, ids = _bronze(spark), spark.createDataFrame([(3,), (3,), (7,), (99,), (None,)], "job_id LONG")
    found = C.bookmark_lookup(S.silver_jobs(bronze), bronze, ids)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 2
    assert sorted((r.job_id, r.description) for r in found.collect()) == [(3, "text 3")] * 4 + [(7, "text 7")]


def test_offline_page_joins_its_rows_only(spark):
    """bronze is joined to the rows of the page, not to all of silver."""
    bronze = _bronze(spark)
    page = SV.jobs_page_offline(S.silver_jobs(bronze), bronze, seniority="Senior", min_salary=120000, limit=6)
    assert "LeftSemi" in page._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.id, r.url) for r in page.collect()] == [(i, f"https://example.com/{i}") for i in (0, 0, 1, 1, 2, 2)]
