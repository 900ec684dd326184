"""Landed-source readers on small hand-written files (the reference's fetcher cases)."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from hirelake.sources import landed as LD


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path.parent)


def test_envelope_and_category_union(spark, tmp_path):
    a = write(tmp_path / "f0" / "part-0.json", json.dumps({"jobs": [
        {"id": 1, "url": "https://x/1", "title": "A", "company_name": "C"},
        {"id": 0, "url": "https://x/0", "title": "Z", "company_name": "C"},
    ]}) + "\n")
    b = write(tmp_path / "f1" / "part-0.json", json.dumps({"jobs": [
        {"id": 1, "url": "https://x/1-dup", "title": "A2", "company_name": "C"},
        {"id": 2, "url": "https://x/2", "title": "B", "company_name": "C"},
        {"url": "https://x/none", "title": "N"},
    ]}) + "\n")
    env = LD.src_envelope(spark, a)
    assert env.count() == 2 and sorted(env.first()["_keys"]) == ["company_name", "id", "title", "url"]
    got = {r["id"]: r["url"] for r in LD.src_category_union(spark, [a, b]).collect()}
    assert got == {"1": "https://x/1", "2": "https://x/2"}


def test_remoteok_normalisation(spark, tmp_path):
    path = write(tmp_path / "rok" / "page.json", json.dumps([
        {"legal": "notice"},
        {"id": "r42", "position": "Dev", "company": "Co", "tags": ["Python", "SQL"], "epoch": 1700000000},
        {"id": "rx", "position": "Bad id"},
        {"id": "7", "tags": "go, rust", "date": "2026-01-02T03:04:05+00:00", "location": ""},
    ]))
    rows = {r["title"]: r for r in LD.norm_remoteok(spark, path).collect()}
    assert set(rows) == {"Dev", "Unknown Role"}
    dev = rows["Dev"]
    assert dev["category"] == "Python" and dev["publication_date"] == "2023-11-14T22:13:20+00:00"
    assert 500_000_000 <= int(dev["id"]) < 1_500_000_000 and dev["url"] == "https://remoteok.com/remote-jobs/42"
    other = rows["Unknown Role"]
    assert json.loads(other["tags"]) == ["go", "rust"] and other["candidate_required_location"] == "Worldwide"
    assert other["company_name"] == "Unknown Company"


def test_arbeitnow_defaults(spark, tmp_path):
    path = write(tmp_path / "arb" / "p.json", json.dumps({"data": [
        {"slug": "s-1", "title": "T", "company_name": "C", "remote": True, "job_types": [], "created_at": 0},
        {"title": "T2", "company_name": "C", "location": "Berlin", "job_types": ["contract"]},
    ]}) + "\n")
    rows = {r["title"]: r for r in LD.norm_arbeitnow(spark, path).collect()}
    assert rows["T"]["candidate_required_location"] == "Remote" and rows["T"]["job_type"] == "full_time"
    assert rows["T"]["url"] == "https://www.arbeitnow.com/jobs/s-1"
    assert rows["T"]["publication_date"] == "1970-01-01T00:00:00+00:00"
    assert rows["T2"]["job_type"] == "contract" and rows["T2"]["url"].endswith("/T2")


def test_jsearch_keywords_salary_and_dedupe(spark, tmp_path):
    job = {"job_id": "abc", "job_apply_link": "https://apply", "job_title": "ML Engineer",
           "employer_name": "Acme", "job_posted_at_datetime_utc": "2026-06-01T00:00:00Z",
           "job_min_salary": 120000, "job_max_salary": None, "job_salary_currency": "USD",
           "job_highlights": {"Qualifications": ["Python and PyTorch", "FastAPI, Django"]}}
    q0 = write(tmp_path / "js" / "q0" / "p.json", json.dumps({"data": [job, {"job_id": ""}]}) + "\n")
    dup = dict(job, job_title="Second copy")
    q1 = write(tmp_path / "js" / "q1" / "p.json", json.dumps({"data": [dup]}) + "\n")
    rows = LD.norm_jsearch(spark, [q0, q1]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["title"] == "ML Engineer" and json.loads(r["tags"]) == ["python", "pytorch", "fastapi", "django"]
    assert r["salary"] == "120000- USD" and r["category"] == "python"


def test_merge_priority_by_url(spark, tmp_path):
    def frame(src, url, idx):
        return spark.createDataFrame([(src, url, "f", 0, idx)], "source STRING, url STRING, _file STRING, _line LONG, _idx LONG")
    merged = LD.merge_sources({
        "jsearch": frame("jsearch", "https://same", 0),
        "remotive": frame("remotive", "https://same", 5),
        "remoteok": frame("remoteok", "", 0),
        "arbeitnow": frame("arbeitnow", "", 1),
    })
    got = sorted((r["source"], r["url"]) for r in merged.collect())
    assert got == [("arbeitnow", ""), ("remoteok", ""), ("remotive", "https://same")]


def test_csv_reads_text_and_fallback(spark, tmp_path):
    csv = tmp_path / "csv" / "jobs.csv"
    csv.parent.mkdir()
    csv.write_text('id,url,title,company_name,company_logo,category,tags,job_type,publication_date,'
                   'candidate_required_location,salary,description\n'
                   '7,https://x/7," Data, Engineer ",Co,,,"[\'python\']",full_time,2026-06-01T00:00:00+00:00,,,"multi\nline"\n')
    name, df = LD.source_fallback(spark, lambda: None, str(tmp_path / "missing"), str(csv.parent))
    r = df.first()
    assert name == "kaggle" and r["title"] == " Data, Engineer " and r["description"] == "multi\nline"
    assert r["salary"] == "" and r["source"] == "kaggle"
    assert LD.source_resolve("jsearch") == "jsearch" and LD.source_resolve("other") == "remotive"
    _ = F


def test_fallback_on_a_failing_read_of_the_default_source_only(spark, tmp_path):
    csv = tmp_path / "csv"
    csv.mkdir()
    (csv / "p.csv").write_text("id,url,title\n1,https://x,t\n")
    broken = tmp_path / "broken"
    broken.mkdir()
    (broken / "part.parquet").write_text("this is no parquet file")
    read = lambda: spark.read.schema("id STRING").parquet(str(broken))
    name, df = LD.source_fallback(spark, read, str(broken), str(csv))
    assert name == "kaggle" and df.count() == 1
    with pytest.raises(Exception):
        LD.source_fallback(spark, read, str(broken), str(csv), source="jsearch")
