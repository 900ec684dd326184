"""Deep pages, verified copies, term containment, layers written once."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from hirelake.operators import matching as M
from hirelake.operators import serving as SV
from hirelake.operators import silver as S
from hirelake.operators import validate as V
from hirelake.operators.strategy import observed
from hirelake.plans import manifest, paging, sinks
from hirelake.session import scratch_path
from tests.test_validation import RAW, rec


def test_pages_read_the_files_that_hold_them(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, *range(40)])) for i in range(1000)]
    pages = paging.Pages(spark, scratch_path(spark, "pages"))
    pages.build(spark.createDataFrame(rows, "id long, at long"), [("at", True), ("id", False)], file_rows=60)
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    got = []
    for n in range(1, 45):
        page = [tuple(r) for r in pages.page(n, 23).collect()]
        assert page == want[(n - 1) * 23: n * 23]
        got += page
        assert len(pages.files((n - 1) * 23, 23)[0]) <= 3
    assert got == want and len(manifest.load(spark, pages.root)["files"]) > 10
    assert pages.page(1000, 50).collect() == []
    pages.build(spark.createDataFrame([], "id long, at long"), [("id", False)])
    assert pages.page(1, 10).collect() == []
    with pytest.raises(ValueError):
        pages.page(0, 10)


def test_verified_copy_finds_a_wrong_row(spark):
    df = spark.createDataFrame([(i, f"v{i}", [str(i)]) for i in range(50)] + [(None, None, None)] * 3, "id long, v string, t array<string>")
    dst = scratch_path(spark, "copy")
    got = sinks.verified_copy(spark, {"a": df, "none": None, "empty": df.limit(0)}, dst).collect()
    assert [tuple(r) for r in got] == [("a", 53, 53, True)]
    copy = spark.read.parquet(f"{dst}/a")
    assert sinks.check_copy(df, copy.repartition(5)) == (53, 53, True)
    planted = copy.withColumn("v", F.when(F.col("id") == 7, "wrong").otherwise(F.col("v")))
    assert sinks.check_copy(df, planted) == (53, 53, False)
    swapped = copy.filter("id is not null").unionByName(copy.filter("id = 3")).unionByName(copy.filter("id is null").limit(2))
    assert sinks.check_copy(df, swapped) == (53, 53, False)


@pytest.mark.parametrize("at_once", [3, 1000])
def test_contained_terms(spark, monkeypatch, at_once):
    monkeypatch.setattr(M, "ROLES_AT_ONCE", at_once)
    rng = random.Random(at_once)
    texts = ["".join(rng.choices("abé ", k=rng.randint(0, 30))) for _ in range(60)] + [None, ""]
    terms = ["".join(rng.choices("abé ", k=rng.randint(0, 3))) for _ in range(30)] + [None, "zzz"]
    got = M.contained_terms(spark.createDataFrame([(t,) for t in texts], "text string"),
                            spark.createDataFrame([(t,) for t in terms], "term string")).collect()
    want = {(t, w) for t in texts if t is not None for w in terms if w and w in t}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    none = spark.createDataFrame([], "term string")
    assert M.contained_terms(spark.createDataFrame([("x",)], "text string"), none).collect() == []


def test_enriched_rows_equal_the_join(spark):
    rows = [rec(id=str(k), url=f"https://x/{k}", title=t, salary=s, _pos=k) for k, t, s in (
        (1, "Lead Dev", "$120k"), (2, "Junior  Dev", None), (3, "Dev", "€80,000 - €95,000"), (4, "Senior x", "$50/hr"))]
    bronze = V.valid_rows(V.validate(spark.createDataFrame(rows, RAW), ingested_at=F.lit("2026-07-01").cast("timestamp")))
    joined = SV.jobs_enriched(bronze, S.silver_jobs(bronze))
    assert SV.enriched_rows(bronze).columns == joined.columns
    assert sorted(map(str, SV.enriched_rows(bronze).collect())) == sorted(map(str, joined.collect()))
    for more in ({}, {"seniority": "senior"}, {"min_salary": 90000}, {"source": "remotive", "page": 2, "page_size": 2}):
        a = SV.jobs_page_of(bronze, **more).collect()
        assert a == SV.jobs_page(bronze, S.silver_jobs(bronze), **more).collect()


def test_metrics_are_observed_on_the_write(spark):
    df, seen = observed(spark.range(10), {"n": F.count(F.lit(1)), "even": F.count_if(F.col("id") % 2 == 0)})
    assert (seen, df.count()) == ({"n": 10, "even": 5}, 10)
