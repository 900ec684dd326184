"""Stored dead letters: appends of several runs, backfill passes, hot keys."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from hirelake.operators import changes as C
from hirelake.operators import validate as V
from hirelake.plans import jobs as J
from hirelake.session import scratch_path
from hirelake.sources import landed as LD
from hirelake.streaming import ingest as ST


def _record(i, ok):
    return {"id": i, "url": f"https://x/{i}" if ok else "", "title": f"t{i}", "company_name": "c", "publication_date": "2026-06-10"}


def _land(folder, files):
    """One file per list of envelopes, one envelope per line."""
    for name, lines in files.items():
        with open(f"{folder}/{name}.json", "w") as f:
            for recs in lines:
                f.write(json.dumps({"jobs": recs}) + "\n")


def test_two_landed_folders_store_all_failures(spark, tmp_path):
    t = J.Tables(scratch_path(spark, "two-folders"))
    same = _record(7, False)
    for n, sub in enumerate(("a", "b")):
        (tmp_path / sub).mkdir()
        bad = [_record(100 * n + i, False) for i in range(5)]
        _land(tmp_path / sub, {"p0": [bad[:2], bad[2:], [same], [same]], "p1": [[_record(900 + n, True)]]})
        J.ingest(spark, LD.src_envelope(spark, str(tmp_path / sub)), t)
    dead = J.dead_letters(spark, t)
    assert dead.count() == dead.select("id").distinct().count() == 14
    J.ingest(spark, LD.src_envelope(spark, str(tmp_path / "b")), t)  # a replay adds nothing
    assert J.dead_letters(spark, t).count() == 14


def test_rows_without_position(spark):
    t = J.Tables(scratch_path(spark, "made-up"))
    schema = "id STRING, url STRING, title STRING, company_name STRING, publication_date STRING"
    for n in range(2):
        J.ingest(spark, spark.createDataFrame([(str(100 * n + i), "", "t", "c", "2026-06-10") for i in range(10)], schema), t)
    assert J.dead_letters(spark, t).count() == 20


def test_backfill_passes_keep_state(spark, tmp_path):
    t = J.Tables(scratch_path(spark, "passes"))
    bad = [_record(i, False) for i in range(3)] + [{**_record(10 + i, True), "url": f"x.com/{i}"} for i in range(4)]
    _land(tmp_path, {"p": [bad, [_record(50, True)]]})
    J.ingest(spark, LD.src_envelope(spark, str(tmp_path)), t)
    first, second = (tuple(J.backfill(spark, t, limit=None).first()) for _ in range(2))
    assert first == (7, 4, 3) and second == (3, 0, 3)
    state = J.dead_letters(spark, t).groupBy("resolved", "retry_count").count().collect()
    assert {tuple(r) for r in state} == {(True, 0, 4), (False, 2, 3)}
    with_limit = tuple(J.backfill(spark, t, limit=2).first())
    assert with_limit == (2, 0, 2)


def test_stream_dead_letters_are_unique_and_replayed_once(spark, tmp_path):
    lines = [[_record(i, False), _record(i + 50, i % 2 == 0)] for i in range(8)] + [[_record(1, False)]]
    _land(tmp_path, {"p0": lines, "p1": lines[:3]})
    t = J.Tables(scratch_path(spark, "stream-dead"))
    for _ in range(2):
        q = ST.start_ingest(spark, str(tmp_path), t, scratch_path(spark, "ckpt"), refresh_gold=False)
        ST.run_until_idle(q)
        dead = J.dead_letters(spark, t)
        bad = sum(r["url"] == "" for f in (lines, lines[:3]) for line in f for r in line)
        assert dead.count() == dead.select("id").distinct().count() == bad


def test_stream_last_line_wins(spark, tmp_path):
    lines = [[{**_record(1, True), "title": f"v{i}"}] for i in range(30)]
    _land(tmp_path, {"p": lines})
    t = J.Tables(scratch_path(spark, "stream-order"))
    ST.run_until_idle(ST.start_ingest(spark, str(tmp_path), t, scratch_path(spark, "ckpt"), refresh_gold=False))
    from hirelake.plans import sinks

    assert [r.title for r in sinks.read_table(spark, t.path("bronze_jobs")).collect()] == ["v29"]


def test_many_equal_failures_keep_a_row_each(spark):
    raw = spark.range(300).select(
        F.lit("x").alias("id"), F.lit("u").alias("url"), F.lit("t").alias("title"), F.lit("c").alias("company_name"),
        F.lit("2026-06-10").alias("publication_date"))
    dead = V.dead_letters(V.validate(raw))
    assert dead.count() == dead.select("id").distinct().count() == 300


def test_bookmark_fold_splits_a_hot_job(spark, monkeypatch):
    from hirelake.operators import strategy

    monkeypatch.setattr(strategy, "BROADCAST_MAX_BYTES", 0)
    monkeypatch.setattr(strategy.salted_join, "__defaults__", (10,))
    rows = []
    for i in range(120):
        job = 1 if i % 3 == 0 else i
        rows.append((i, i, "remove" if i == 60 else "add" if i % 2 == 0 else "note", job, f"n{i}"))
    events = spark.createDataFrame(rows, "event_id long, ts long, action string, job_id long, notes string") \
        .withColumn("ts", F.timestamp_seconds("ts"))
    got = {r.job_id: (r.id, r.notes) for r in C.bookmark_state(events).collect()}
    want = {}
    for job in {r[3] for r in rows}:
        mine = [r for r in rows if r[3] == job]
        cut = max([r[0] for r in mine if r[2] == "remove"], default=-1)
        adds = [r for r in mine if r[2] == "add" and r[0] > cut]
        notes = [r for r in mine if r[2] == "note" and r[0] > cut]
        if adds:
            late = notes and notes[-1][0] > adds[0][0]
            want[job] = (adds[0][0], notes[-1][4] if late else adds[0][4])
    assert got == want
