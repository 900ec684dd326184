"""Versioned tables: merge-on-read upserts, change feed, commits, incremental gold."""

from __future__ import annotations

import os
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from hirelake.operators import gold as G
from hirelake.operators import silver as S
from hirelake.operators import validate as V
from hirelake.plans import manifest as M
from hirelake.plans import sinks, versioned, views
from hirelake.plans.versioned import Table
from hirelake.session import scratch_path
from tests.test_validation import RAW, rec

SCHEMA = "id long, v string, first long, _seq long"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _table(spark, n=1000, files=8):
    t = Table(spark, scratch_path(spark, "versioned"))
    df = spark.range(n).select("id", F.concat(F.lit("a"), "id").alias("v"), F.col("id").alias("first"))
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(files))
    try:
        t.refresh(df)
    finally:
        spark.conf.set(conf, "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    return t


def _state(df):
    return {r.id: (r.v, r.first) for r in df.collect()}


def test_a_small_batch_reads_and_writes_few_files(spark):
    t = _table(spark)
    before = t.manifest()
    assert len(before["files"]) == 8
    t.upsert(_rows(spark, [(i, "b", -1, 0) for i in range(300, 310)]), keep_first=["first"])
    m = t.manifest()
    assert [f for f in m["files"] if f["level"] == 0] == before["files"]  # nothing rewritten
    assert len(m["looked_up"]) == 1 and sum(f["rows"] for f in m["added"]) == 10
    state = _state(t.read())
    assert len(state) == 1000 and state[305] == ("b", 305) and state[310] == ("a310", 310)
    plan = t.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") >= 3  # clear base files pass by the anti join


def test_random_upserts_against_a_dict(spark):
    rng = random.Random(5)
    t, want, history = Table(spark, scratch_path(spark, "versioned")), {}, {}
    for step in range(6):
        batch = [(rng.randrange(60) + 40 * (step % 2), f"s{step}.{i}", step * 100 + i, i) for i in range(rng.randrange(1, 40))]
        for i, v, first, _ in batch:
            want[i] = (v, want[i][1] if i in want else first)
        history[t.upsert(_rows(spark, batch), keep_first=["first"])] = dict(want)
        if step == 3:
            history[t.compact()] = dict(want)
    assert _state(t.read()) == want
    for version, state in history.items():
        assert _state(t.read(version)) == state
    assert {f["level"] for f in t.manifest()["files"]} != {0}


def test_changes_between_versions(spark):
    t = _table(spark, 100, 4)
    a = t.version()
    t.upsert(_rows(spark, [(5, "b", 0, 0), (200, "new", 0, 0)]))
    t.compact()
    b = t.upsert(_rows(spark, [(5, "c", 0, 0), (6, "d", 0, 0)]))
    got = {r.key: (r.old and r.old.v, r.new.v) for r in t.changes(a, b).collect()}
    assert got == {5: ("a5", "c"), 6: ("a6", "d"), 200: (None, "new")}
    assert {r.key for r in t.changes(b - 1, b).collect()} == {5, 6}
    t.refresh(t.read())
    assert t.changes(a, t.version()) is None


def test_many_upserts_are_merged(spark, monkeypatch):
    monkeypatch.setattr(versioned, "MAX_LEVELS", 3)
    t = _table(spark, 50, 2)
    for k in range(5):
        t.upsert(_rows(spark, [(k, f"u{k}", 0, 0)]))
    assert len({f["level"] for f in t.manifest()["files"]}) <= 3
    assert _state(t.read())[3][0] == "u3" and t.read().count() == 50


def test_string_keys_empty_batches_and_null_keys(spark):
    t = Table(spark, scratch_path(spark, "versioned"), "k")
    schema = "k string, n long, _seq long"
    assert t.read() is None
    t.upsert(spark.createDataFrame([], schema))
    assert t.read().collect() == []
    t.upsert(spark.createDataFrame([("é", 1, 0), ("z", 2, 0), ("é", 3, 1)], schema))
    t.upsert(spark.createDataFrame([("日", 4, 0), ("z", 5, 0)], schema))
    v = t.version()
    assert t.upsert(spark.createDataFrame([], schema)) == v
    assert {tuple(r) for r in t.read().collect()} == {("é", 3), ("z", 5), ("日", 4)}
    with pytest.raises(Exception, match="null k"):
        t.upsert(spark.createDataFrame([(None, 1, 0)], schema))


def test_a_table_written_as_a_whole_takes_upserts(spark):
    root = scratch_path(spark, "whole")
    sinks.write_table(spark.range(5).select("id", F.lit("a").alias("v"), F.col("id").alias("first")), root)
    t = Table(spark, root)
    assert t.read().count() == 5
    t.upsert(_rows(spark, [(3, "b", 9, 0), (7, "c", 9, 0)]), keep_first=["first"])
    assert _state(sinks.read_table(spark, root)) == {0: ("a", 0), 1: ("a", 1), 2: ("a", 2), 3: ("b", 3), 4: ("a", 4), 7: ("c", 9)}


def test_one_of_two_writers_wins_a_version(spark):
    root = scratch_path(spark, "race")
    M.commit(spark, root, {"files": []}, 0)
    with pytest.raises(M.Conflict):
        M.commit(spark, root, {"files": ["x"]}, 0)
    assert M.load(spark, root) == {"files": [], "version": 0}
    assert [x for x in M.children(spark, f"{root}/_log") if x.startswith("_draft")] == []


def test_concurrent_upserts_lose_nothing(spark):
    t = _table(spark, 100, 4)
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda k: t.upsert(_rows(spark, [(k, f"w{k}", 0, 0), (500 + k, "n", 0, 0)])), range(6)))
    state = _state(t.read())
    assert all(state[k][0] == f"w{k}" and state[500 + k][0] == "n" for k in range(6)) and len(state) == 106


def test_old_versions_go(spark, monkeypatch):
    monkeypatch.setattr(sinks, "KEEP", 2)
    root = scratch_path(spark, "refreshed")
    paths = [sinks.write_table(spark.range(k + 1), root) for k in range(5)]
    assert sinks.read_table(spark, root).count() == 5
    local = [p.removeprefix("file:") for p in paths]
    assert [os.path.exists(p) for p in local[:2]] == [False, False] and os.path.exists(local[-1])
    assert len(M.versions(spark, root)) == 2


def _bronze(spark, rows):
    return V.valid_rows(V.validate(spark.createDataFrame(rows, RAW)))


def _gold(spark, root, bronze):
    silver = S.silver_jobs(bronze.read())
    want = {"gold_country_trends": G.gold_country_trends(silver), "gold_skill_trends": G.gold_skill_trends(silver),
            "gold_role_trends": G.gold_role_trends(silver), "gold_time_trends": G.gold_time_trends(silver)}
    return {v: ({tuple(r) for r in views.read(spark, root, v).collect()}, {tuple(r) for r in df.collect()}) for v, df in want.items()}


def test_gold_follows_moved_postings(spark, monkeypatch):
    monkeypatch.setattr(views, "MAX_FILES", 2)
    bronze, root = Table(spark, scratch_path(spark, "bronze")), scratch_path(spark, "gold-counts")
    silver = Table(spark, scratch_path(spark, "silver"), "job_id")
    make = lambda k, **more: rec(id=str(k), url=f"https://x/{k}", _pos=k, **more)
    batches = [
        [make(k, tags="python, sql", publication_date=f"2026-0{1 + k % 3}-10") for k in range(1, 9)],
        [make(2, tags="rust", publication_date="2026-09-01", candidate_required_location="Berlin, Germany")],
        [make(2, tags="rust", publication_date="2026-09-01"), make(20, tags="[]", publication_date="2026-09-05")],
        [make(3, title="Another Role", publication_date="2026-01-10")],
    ]
    for rows in batches:
        bronze.upsert(_bronze(spark, rows).withColumn("_seq", F.lit(0)), keep_first=["ingested_at"])
        for _ in range(2):  # again: nothing is applied twice
            views.refresh(spark, bronze, root, silver)
        for got, want in _gold(spark, root, bronze).values():
            assert got == want
    assert {r.job_id for r in silver.read().collect()} == {*range(1, 9), 20}
    # two versions at once, and a feed that is gone
    bronze.upsert(_bronze(spark, batches[1]).withColumn("_seq", F.lit(0)))
    bronze.upsert(_bronze(spark, batches[0][:3]).withColumn("_seq", F.lit(0)))
    views.refresh(spark, bronze, root)
    assert all(a == b for a, b in _gold(spark, root, bronze).values())
    bronze.refresh(bronze.read())
    bronze.upsert(_bronze(spark, batches[3]).withColumn("_seq", F.lit(0)))
    views.refresh(spark, bronze, root)
    assert all(a == b for a, b in _gold(spark, root, bronze).values())


def test_refresh_reads_changed_postings_only(spark):
    bronze, root = Table(spark, scratch_path(spark, "bronze")), scratch_path(spark, "gold-counts")
    make = lambda k, **more: rec(id=str(k), url=f"https://x/{k}", _pos=k, **more)
    bronze.upsert(_bronze(spark, [make(k) for k in range(1, 60)]).withColumn("_seq", F.lit(0)))
    views.refresh(spark, bronze, root)
    bronze.upsert(_bronze(spark, [make(7, publication_date="2026-11-01")]).withColumn("_seq", F.lit(0)))
    views.refresh(spark, bronze, root)
    signed = spark.read.parquet(f"{root}/{M.load(spark, root)['files'][-1]['path']}").collect()
    assert {r.job_count for r in signed} <= {-1, 1} and 0 < len(signed) < 12
