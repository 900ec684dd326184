"""Scalar operators: the reference's own cases plus the gotchas listed in FIXTURES.md."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hirelake.functions import enrich
from hirelake.functions import parse as P
from hirelake.functions import terms as T


def one(spark, col, value, schema="v STRING"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


@pytest.mark.parametrize("title,expected", [
    ("Lead Python Engineer", "Lead"), ("Principal Data Scientist", "Lead"),
    ("Senior Software Engineer", "Senior"), ("Sr. Developer", "Senior"),
    ("Junior Data Analyst", "Junior"), ("Frontend Intern", "Junior"),
    ("Database Administrator", "Mid-level"),
    ("Headquarters Clerk", "Lead"), ("International Sales", "Junior"),
])
def test_seniority(spark, title, expected):
    assert one(spark, enrich.classify_seniority(F.col("v"), F.lit(None).cast("string")), title) == expected


@pytest.mark.parametrize("salary,description,expected", [
    ("$120k - $160k", None, (120000.0, 160000.0, "USD")),
    ("100,000 - 130,000", None, (100000.0, 130000.0, "USD")),
    ("£40k - £60k", None, (40000.0, 60000.0, "GBP")),
    ("€80,000 - €95,000", None, (80000.0, 95000.0, "EUR")),
    ("$110k", None, (110000.0, 110000.0, "USD")),
    (None, "We pay $130,000 to $170,000 per year.", (130000.0, 170000.0, "USD")),
    (None, "The hourly pay rate is $50 - $70/hr for this role.", (100000.0, 140000.0, "USD")),
    ("120000-180000 USD", None, (None, None, None)),
    ("401k", None, (401000.0, 401000.0, "USD")),
    (None, "10 Kubernetes clusters", (10000.0, 10000.0, "USD")),
    (None, "A neural search team paying $100k", (100000.0, 100000.0, "EUR")),
    (None, None, (None, None, None)),
])
def test_parse_salary(spark, salary, description, expected):
    df = spark.createDataFrame([(salary, description)], "s STRING, d STRING")
    r = df.select(enrich.parse_salary(F.col("s"), F.col("d")).alias("x")).first()["x"]
    assert (r["salary_min"], r["salary_max"], r["salary_currency"]) == expected


@pytest.mark.parametrize("loc,expected", [
    (None, "Unknown"), ("  ", "Unknown"), ("Berlin,", "Unknown"), ("Remote, USA", "USA"),
    ("Worldwide", "Global"), ("global team", "Global"), ("Toronto, Canada", "Canada"), (" Spain ", "Spain"),
])
def test_infer_country(spark, loc, expected):
    assert one(spark, enrich.infer_country(F.col("v")), loc) == expected


def test_normalize_role(spark):
    assert one(spark, enrich.normalize_role(F.col("v")), "  Senior   Data\tEngineer ") == "Senior Data Engineer"


@pytest.mark.parametrize("raw,expected", [
    ("['Python', 'SQL', 'python']", ["python", "sql"]),
    ("python, SQL ,, dbt", ["python", "sql", "dbt"]),
    ("[broken, list", ["[broken", "list"]),
    ("[a, b]", ["a", "b"]),
    ("", []), (None, []), ("[]", []),
])
def test_normalize_tags(spark, raw, expected):
    assert one(spark, P.normalize_tags(F.col("v")), raw) == expected


@pytest.mark.parametrize("raw,ok", [
    ("2026-06-10T12:00:00Z", True), ("2026-06-10T12:00:00+02:00", True), ("2026-06-10", True),
    ("2026-06-10 12:00", True), ("2026-06", False), ("12:00", False), ("not a date", False),
])
def test_iso_timestamp_guard(spark, raw, ok):
    assert (one(spark, P.parse_iso_timestamp(F.col("v")), raw) is not None) == ok


def test_iso_timestamp_to_utc(spark):
    v = one(spark, P.parse_iso_timestamp(F.col("v")), "2026-06-10T14:00:00+02:00")
    assert v == dt.datetime(2026, 6, 10, 12, 0, 0)


def test_job_terms_gotchas(spark):
    df = spark.createDataFrame([(["Python", "SQL"], "Senior C++ / C# .NET engineer")], "tags ARRAY<STRING>, title STRING")
    terms = df.select(T.job_terms(F.col("tags"), F.col("title")).alias("t")).first()["t"]
    assert terms[:2] == ["python", "sql"]
    assert "c" in terms and "net" in terms and "c++" not in terms


def test_resume_skills_first_occurrence(spark):
    text = "Python and SQL experience; python again, Go and R. The team uses dbt."
    got = one(spark, T.resume_skills(F.col("v")), text)
    # stopwords (and, experience, the, team) dropped; "go" and "r" kept; first occurrence order
    assert got == ["python", "sql", "again", "go", "r", "uses", "dbt"]


def test_qualification_keywords(spark):
    quals = ["Strong Python and PyTorch skills", "FastAPI or Django; python"]
    df = spark.createDataFrame([(quals,)], "q ARRAY<STRING>")
    got = df.select(T.qualification_keywords(F.col("q")).alias("k")).first()["k"]
    assert got == ["python", "pytorch", "fastapi", "django"]


def test_stable_id_is_reproducible(spark):
    df = spark.createDataFrame([("abc",), ("abc",), ("abd",)], "k STRING")
    ids = [r["i"] for r in df.select(T.stable_id("remoteok", F.col("k"), 500_000_000).alias("i")).collect()]
    assert ids[0] == ids[1] != ids[2]
    assert all(500_000_000 <= i < 1_500_000_000 for i in ids)


ISO_SHAPES = [
    "20260610T120000", "2026-06-10T12:00:00.1234567Z", "2026-06-10t12:00:00Z", "2026-W24-3", "2026W243", "2026W24",
    "2026-W24", "2026-W53-1", "2025-W53-1", "2026-W54-1", "20260610", "2026-06-10 12", "20260610T1200", "20260610T12:00:00+0530",
    "2026-06-10T12:00:00,5-05:00", "2026-06-10_12:00", "2026-06", "12:00", "2026-06-1", "2026-13-01", "202606101", "",
    "2026-W24-3T10:11:12Z", "2026-06-10T1", "nonsense",
]


@pytest.mark.parametrize("text", ISO_SHAPES)
def test_iso_shapes_as_python(spark, text):
    import datetime as dt

    try:
        want = dt.datetime.fromisoformat(text)
    except ValueError:
        want = None
    got = one(spark, F.unix_micros(P.parse_iso_timestamp(F.col("v"))), text)
    if want is None:
        assert got is None
    else:
        utc = want if want.tzinfo else want.replace(tzinfo=dt.timezone.utc)
        assert got == (utc - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
