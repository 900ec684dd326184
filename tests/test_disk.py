"""Texts are not stored or shuffled more often than the job needs (round 4)."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from hirelake.plans import catalog_sources, manifest as M, versioned as VT
from hirelake.session import checkpoint_root, scratch_path
from hirelake.sources import landed as LD
from hirelake.sources import landing as LG
from hirelake.sources import ranges as R
from hirelake.sources import testdata as TD
from tests.conftest import SF_SMALL


def _stored(spark) -> set[str]:
    return set(M.children(spark, f"{checkpoint_root(spark)}/hirelake"))


@pytest.mark.parametrize("read, text", [
    (R.csv_records, "id,url\n1,\"two\nlines\"\n2,u\n"), (R.json_records, '[{"legal": 1},{"id": "}"},{"id": 2}]')])
def test_records_of_whole_files_are_neither_stored_nor_shuffled(spark, tmp_path, read, text):
    """Reading a file by ranges leaves no copy of its text."""
    (tmp_path / "a.txt").write_text(text)
    before = _stored(spark)
    got = read(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert len(got.collect()) == (2 if read is R.csv_records else 3)
    assert _stored(spark) == before


def _raw(spark):
    rows = [(str(k), f"https://x/{k}", f"role {k}", "acme", None, f"cat {k % 3}", "a, b", "full_time", "2024-01-02T03:04:05Z",
             "Peru", "$50k", f"text {k % 5}", "remotive", k) for k in range(40)]
    cols = ["id", "url", "title", "company_name", "company_logo", "category", "tags", "job_type", "publication_date",
            "candidate_required_location", "salary", "description", "source", "_pos"]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'LONG' if c == '_pos' else 'STRING'}" for c in cols))


def _files(path):
    found = [os.path.join(d, f) for d, _, fs in os.walk(path.split(":", 1)[-1]) for f in fs if f.startswith("part-")]
    return found


@pytest.mark.parametrize("land, read", [
    (LG.land_envelopes, lambda s, p: LD.src_envelope(s, p)), (LG.land_remoteok, lambda s, p: LD.norm_remoteok(s, p)),
    (LG.land_arbeitnow, lambda s, p: LD.norm_arbeitnow(s, p)), (LG.land_csv, lambda s, p: LD.src_csv(s, p)),
    (LG.land_category_fetches, lambda s, p: LD.src_category_union(s, p))])
def test_descriptions_joined_after_dealing_land_the_same(spark, land, read):
    """the postings are dealt without their texts; what is read back is the same."""
    raw = _raw(spark)
    texts = F.broadcast(raw.select("_pos", F.col("description").alias("d")))
    late = TD.Descriptions(lambda df: df.join(texts, "_pos").withColumn("description", F.col("d")).select(*df.columns), 3)
    got = []
    for rows, describe in ((raw, None), (raw.withColumn("description", F.lit(None).cast("string")), late)):
        path = scratch_path(spark, "landed-late")
        where = land(rows, path, describe=describe) or path
        assert _files(path)
        out = read(spark, where)
        got.append(sorted(tuple(str(v) for v in r) for r in out.drop("_file", "_line", "_idx").collect()))
    assert got[0] == got[1] and len(got[0]) >= 39


def test_merge_keeps_the_files_of_one_source_at_a_time(spark):
    """a source's landed files go when what the merge reads of them is stored."""
    before = _stored(spark)
    merged = catalog_sources.q_merge_sources(spark, SF_SMALL)
    root = next(x for x in _stored(spark) - before if x.startswith("all-sources"))
    assert M.children(spark, f"{checkpoint_root(spark)}/hirelake/{root}") == []
    assert merged.columns == ["origin", "id", "url"] and merged.count() > 1500


SCHEMA = "id LONG, a STRING, b STRING, at LONG, _seq LONG"


def _rows(df):
    return sorted(((r.id, (r.a, r.b, r.at)) for r in df.collect()), key=lambda r: r[0])


def _batch(spark, rows):
    path = scratch_path(spark, "batch")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


def test_stored_batches_are_dealt_in_slices(spark, monkeypatch):
    """upserts and compaction, slice by slice, against a dict."""
    monkeypatch.setattr(VT, "SLICE_BYTES", 1)
    rng, table, want = random.Random(4), VT.Table(spark, scratch_path(spark, "sliced")), {}
    for n in range(3):
        rows = [(rng.randrange(300), rng.choice(["x", "y", None]), rng.choice(["x", None]), n, i) for i in range(200)]
        for k, a, b, _, _ in rows:
            want[k] = (a, b, want[k][2] if k in want else n)
        table.upsert(_batch(spark, rows), keep_first=["at"], stored=True)
        assert len({f["path"].split("/")[0] for f in table.manifest()["added"]}) > 1
        assert _rows(table.read()) == sorted(want.items(), key=lambda r: r[0])
    table.compact()
    files = table.manifest()["files"]
    assert {f["level"] for f in files} == {0} and len({f["path"].split("/")[0] for f in files}) > 1
    assert _rows(table.read()) == sorted(want.items(), key=lambda r: r[0])


def test_a_replayed_batch_writes_nothing(spark):
    """rows stored as they are already are not written again; others are."""
    table = VT.Table(spark, scratch_path(spark, "replayed"))
    table.upsert(_batch(spark, [(k, "x", None, 1, 0) for k in range(9)]), keep_first=["at"], stored=True)
    first = table.version()
    table.upsert(_batch(spark, [(k, "x", None, 2, 0) for k in range(9)]), keep_first=["at"], stored=True)
    assert table.manifest()["added"] == [] and table.unchanged(first, table.version())
    changed = [(0, None, "x", 3, 0), (1, "x", "x", 3, 0), (2, None, None, 3, 0), (3, "x", None, 3, 0), (9, "x", None, 3, 0)]
    table.upsert(_batch(spark, changed), keep_first=["at"], stored=True)
    assert sum(f["rows"] for f in table.manifest()["added"]) == 4 and not table.unchanged(first, table.version())
    got = {r.id: (r.a, r.b, r.at) for r in table.read().collect()}
    assert got == {k: ("x", None, 1) for k in range(3, 9)} | {0: (None, "x", 1), 1: ("x", "x", 1), 2: (None, None, 1), 9: ("x", None, 3)}


def test_merged_records_keep_cut_ranges(spark, tmp_path):
    """Records that span several ranges are put together whole."""
    rows = [{"id": i, "t": "}" * 150 + '"' + "{" * 50} for i in range(8)]
    (tmp_path / "a.json").write_text(json.dumps(rows))
    keys = {"spark.sql.files.maxPartitionBytes": "40", "spark.sql.files.openCostInBytes": "0"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        got = sorted((json.loads(r._rec) for r in R.json_records(spark, str(tmp_path)).collect()), key=lambda r: r["id"])
    finally:
        for k in keys:
            spark.conf.unset(k)
    assert got == rows
