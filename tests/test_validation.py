"""Validation split, first-error order, missing keys and the dead-letter loop."""

from __future__ import annotations

from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.operators import deadletter as DL
from hirelake.operators import validate as V

RAW = ", ".join(f"{f} STRING" for f in fixed.CANONICAL_FIELDS) + ", _keys ARRAY<STRING>, _pos LONG"
ALL_KEYS = list(fixed.CANONICAL_FIELDS)


def rec(**kw):
    base = {"id": "12345", "url": "https://remotive.com/jobs/12345", "title": "Data Engineer",
            "company_name": "TestCorp", "company_logo": None, "category": "Software",
            "tags": "['python', 'sql']", "job_type": "full_time", "publication_date": "2026-06-10T12:00:00Z",
            "candidate_required_location": None, "salary": None, "description": None, "source": "remotive"}
    keys = kw.pop("_keys", ALL_KEYS)
    pos = kw.pop("_pos", 0)
    base.update(kw)
    return tuple(base[f] for f in fixed.CANONICAL_FIELDS) + (keys, pos)


def test_valid_invalid_split(spark):
    raw = spark.createDataFrame([rec(), rec(id="2", url="invalid-url", _pos=1)], RAW)
    v = V.validate(raw, "remotive")
    s = V.ingest_summary(v, "remotive").first()
    assert (s["fetched"], s["valid"], s["invalid"]) == (2, 1, 1)
    good = V.valid_rows(v).first()
    assert good["tags"] == ["python", "sql"] and str(good["publication_date"]) == "2026-06-10 12:00:00"
    dead = V.dead_letters(v, "remotive").first()
    assert dead["error_message"] == fixed.MSG_URL_PREFIX and dead["resolved"] is False and dead["retry_count"] == 0


def test_first_error_in_field_order(spark):
    raw = spark.createDataFrame([
        rec(id="0", url="", title=" "),
        rec(url="", title=" ", _pos=1),
        rec(title="   ", company_name=None, _pos=2),
        rec(publication_date="2026-06", _pos=3),
        rec(id="abc", _pos=4),
        rec(id=None, _pos=5),
    ], RAW)
    got = [r["error_message"] for r in V.validate(raw).orderBy("_pos").collect()]
    assert got == [fixed.MSG_GT_ZERO, fixed.MSG_STR_SHORT, fixed.MSG_BLANK,
                   fixed.MSG_DATE_PARSE_PREFIX + "'2026-06'", fixed.MSG_INT_PARSE, fixed.MSG_INT_TYPE]


def test_missing_key_vs_null(spark):
    no_title = [k for k in ALL_KEYS if k != "title"]
    no_source = [k for k in ALL_KEYS if k != "source"]
    raw = spark.createDataFrame([
        rec(title=None, _keys=no_title),
        rec(source=None, _keys=no_source, _pos=1),
        rec(source=None, _pos=2),
    ], RAW)
    got = V.validate(raw, "all").orderBy("_pos").collect()
    assert got[0]["error_message"] == fixed.MSG_MISSING
    assert got[1]["error_message"] is None and got[1]["source"] == "all"
    assert got[2]["error_message"] == fixed.MSG_STR_TYPE


def test_backfill_repairs_url(spark):
    raw = spark.createDataFrame([
        rec(id="99", url="example.com/job/99", source="kaggle"),
        rec(id="100", url="", source="kaggle", _pos=1),
    ], RAW)
    dead = V.dead_letters(V.validate(raw, "kaggle"), "kaggle")
    retried = DL.retry(dead, 100)
    s = DL.backfill_summary(retried).first()
    assert (s["retried"], s["recovered"], s["failed"]) == (2, 1, 1)
    rec_row = DL.recovered_rows(retried).first()
    assert rec_row["id"] == 99 and rec_row["url"] == "https://example.com/job/99"
    state = {r["id"]: r for r in DL.apply_outcome(dead, retried).collect()}
    flags = sorted((r["resolved"], r["retry_count"]) for r in state.values())
    assert flags == [(False, 1), (True, 0)]


def test_sanitize_url(spark):
    df = spark.createDataFrame([("//a.com/x",), ("http://ok",), ("",), (None,)], "u STRING")
    got = [r[0] for r in df.select(DL.sanitize_url(F.col("u"))).collect()]
    assert got == ["https://a.com/x", "http://ok", "", None]
