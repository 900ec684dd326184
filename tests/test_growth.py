"""What wide rows cost: shuffles, stored copies and regex passes."""

from __future__ import annotations

import glob
import os

from pyspark.sql import functions as F

from hirelake.functions import enrich
from hirelake.operators import serving as SV
from hirelake.operators import silver as S
from hirelake.operators import validate as V
from hirelake.plans import jobs as J
from hirelake.plans import manifest as M
from hirelake.plans import versioned
from hirelake.plans.versioned import Table
from hirelake.session import scratch_path
from hirelake.sources import landed as LD
from hirelake.sources import landing as LG
from tests.test_validation import RAW, rec


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _raw(spark, n):
    return spark.createDataFrame([rec(id=str(k), url=f"https://x/{k}" if k % 3 else "x", _pos=k) for k in range(1, n)], RAW)


def test_ingest_and_backfill_leave_no_staged_rows(spark):
    t = J.Tables(scratch_path(spark, "growth"))
    summary = J.ingest(spark, _raw(spark, 20), t)
    assert M.children(spark, t.path("_staging")) == []
    assert (summary.first().valid, summary.first().invalid) == (13, 6)
    again = J.backfill(spark, t, limit=None)
    assert M.children(spark, t.path("_staging")) == [] and again.first().recovered == 6
    assert t.bronze(spark).read().count() == 19


def test_valid_rows_are_staged_without_their_raw_values(spark):
    rows = V.staged(V.validate(_raw(spark, 8))).collect()
    assert {(r.error_message is None, r.raw_id is None, r.raw_title is None) for r in rows} == {(True, True, True), (False, False, False)}


def test_upsert_shuffles_whole_rows_once(spark, monkeypatch):
    plans = []
    write = Table._write
    monkeypatch.setattr(Table, "_write", lambda self, df, *a: (plans.append(_plan(df)), write(self, df, *a))[1])
    t = Table(spark, scratch_path(spark, "once"))
    schema = "id long, v string, first long, _seq long"
    t.upsert(spark.createDataFrame([(1, "a", 1, 0), (2, "b", 2, 0)], schema), keep_first=["first"])
    assert plans[-1].count("Exchange") == 1
    monkeypatch.setattr(versioned, "ROWS_PER_SALT", 2)  # key 1 has more rows: folded before
    t.upsert(spark.createDataFrame([(1, f"n{k}", 9 + k, k) for k in range(5)] + [(3, "c", 3, 0)], schema), keep_first=["first"])
    assert {tuple(r) for r in t.read().collect()} == {(1, "n4", 1), (2, "b", 2), (3, "c", 3)}
    t.compact()
    assert plans[-1].count("Exchange") == 1
    assert {tuple(r) for r in t.read().collect()} == {(1, "n4", 1), (2, "b", 2), (3, "c", 3)}


def test_salary_is_read_by_one_pass(spark):
    df = spark.createDataFrame([("1,200,000 12 kg $45k-1,2345 at 60 /hr ٣",)], "d string")
    plan = _plan(df.select(enrich.parse_salary(F.lit(None).cast("string"), F.col("d")).alias("s")).select("s.*"))
    assert plan.count("regexp_extract_all") == 1
    texts = ["$120k - $150k", "€45,000 - €60,000", "£ 30 /hr", "100123-140123 USD", "12345 6\u00a0K", "", "no 7 K or 8k9k", "1,234,56 20\n\tk"]
    df = spark.createDataFrame([(x,) for x in texts], "d string")
    old = F.regexp_extract_all("d", F.lit("(?U)" + enrich.fixed.SALARY_PATTERN), 1)
    ks = F.regexp_extract_all("d", F.lit("(?U)" + enrich.fixed.SALARY_PATTERN), 2)
    new = F.regexp_extract_all("d", F.lit(enrich._AMOUNT), 0)
    for r in df.select(old.alias("n"), ks.alias("k"), new.alias("m")).collect():
        assert [m.strip("kK \u00a0\n\t") for m in r.m] == r.n and [m[-1] if m[-1] in "kK" else "" for m in r.m] == r.k


def test_landed_pages_are_packed_and_in_order(spark):
    path = scratch_path(spark, "landed")
    LG.land_envelopes(_raw(spark, 30), path, page_size=4)
    files = sorted(glob.glob(path.removeprefix("file:") + "/*.gz"))
    assert files and not glob.glob(path.removeprefix("file:") + "/*.txt")
    got = LD.src_envelope(spark, path).orderBy("_file", "_line", "_idx").collect()
    assert [int(r.id) for r in got] == list(range(1, 30))
    assert _plan(LG._paged(_raw(spark, 9), 4, "page").groupBy("page").count()).count("Exchange") == 1


def test_first_of_a_key_reads_only_what_is_asked_for(spark):
    df = spark.createDataFrame([(1, "a", "long", 2), (1, "b", "longer", 1), (2, None, "x", 1)], "k int, v string, wide string, at int")
    first = LD.first_wins(df, "k", ["at"])
    assert {tuple(r) for r in first.collect()} == {(1, "b", "longer", 1), (2, None, "x", 1)}
    assert "wide" not in first.select("k", "v")._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]


def test_salary_queries_read_each_text_once(spark):
    rows = [(1, "a", "France", "$120k", None), (2, "b", "France", None, "pays $45 to 60 /hr"), (3, "c", "Remote", "€90k", None),
            (4, "d", "Spain", None, "no figure")]
    bronze = spark.createDataFrame(rows, "id long, title string, candidate_required_location string, salary string, description string")
    for c in ("source", "company_name", "category"):
        bronze = bronze.withColumn(c, F.lit("x"))
    bronze = bronze.withColumn("tags", F.array(F.lit("t"))).withColumn("publication_date", F.lit("2020-01-02").cast("timestamp"))
    bronze = bronze.localCheckpoint()
    sv = S.silver_jobs(bronze)
    for df in (SV.salary_by_country(sv), SV.salary_by_role(sv), SV.salary_all(sv, "country"), SV.salary_currencies(sv)):
        assert _plan(df).count("regexp_extract_all") == 1
    assert [tuple(r)[:5] for r in SV.salary_by_country(sv).collect()] == [("France", 112500.0, 90000.0, 120000.0, 2)]
    assert [tuple(r) for r in SV.salary_all(sv, "country").collect()] == [
        ("France", 112500.0, 90000.0, 120000.0, 2), ("Remote", 90000.0, 90000.0, 90000.0, 1)]
    assert [r[0] for r in SV.salary_currencies(sv).collect()] == ["EUR", "USD"]


def test_descriptions_are_joined_after_postings_are_dealt(spark):
    full = _raw(spark, 250).withColumn("description", F.concat(F.lit("text "), "_pos"))
    texts = full.select("_pos", "description")
    narrow = full.withColumn("description", F.lit(None).cast("string"))
    describe = lambda df: df.drop("description").join(F.broadcast(texts), "_pos", "left").select(*df.columns)
    dealt = LG._dealt(narrow.withColumn("page", LG._page(narrow, 100)), describe, "page")
    plan = _plan(dealt.groupBy("page").agg(F.collect_list("description")))
    assert plan.count("Exchange rangepartitioning") == 1 and "Exchange hashpartitioning" not in plan
    got = []
    for raw, late in ((full, None), (narrow, describe)):
        csv, pages = scratch_path(spark, "late-csv"), scratch_path(spark, "late-jsearch")
        LG.land_csv(raw, csv, late)
        read = LD.norm_jsearch(spark, LG.land_jsearch(raw, pages, describe=late))
        got.append([sorted(map(str, df.drop("_file", "_line", "_idx").collect())) for df in (LD.src_csv(spark, csv), read)])
    assert got[0] == got[1] and len(got[0][0]) == 249
