"""Readers for landed source extracts (SRC1-SRC5, SRC8-SRC11, SRC13).

HTTP fetching is out of scope: each API response is assumed landed as one
JSON document per line (an envelope such as ``{"jobs": [...]}``), or for
array-shaped APIs as a JSON array file.  Records are read with an explicit
schema; record objects are kept as JSON text first so that a missing key
can be told from an explicit null (``json_object_keys``).

Ordering for first-occurrence rules is ``(file path, position)``: landing
files are named in fetch order, and the position inside a response comes
from ``posexplode``.
"""

from __future__ import annotations

from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.functions import terms as T
from hirelake.functions.text import py_strip
from hirelake.operators.strategy import materialize
from hirelake.sources.ranges import csv_records, json_records

RAW_SCHEMA = ", ".join(f"{f} STRING" for f in fixed.CANONICAL_FIELDS)
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"


def _records(df: DataFrame, array_col: str) -> DataFrame:
    """Explode an envelope array of JSON-text records with landing order.

    Order is (file, line, position): ``monotonically_increasing_id`` grows
    with the line within a file, ``posexplode`` gives the position.
    """
    return df.select(
        F.col("_metadata.file_path").alias("_file"),
        F.monotonically_increasing_id().alias("_line"),
        F.col(array_col),
    ).select("_file", "_line", F.posexplode(array_col).alias("_idx", "_rec"))


def _as_raw(recs: DataFrame) -> DataFrame:
    """Raw canonical columns + ``_keys`` from JSON-text records."""
    return recs.select(
        "*", F.from_json("_rec", RAW_SCHEMA).alias("_p"), F.json_object_keys("_rec").alias("_keys"),
    ).select(*[c for c in recs.columns if c != "_rec"], "_keys", "_p.*")


def read_envelope(spark: SparkSession, path: str, key: str = "jobs") -> DataFrame:
    """Records of ``{key: [...]}`` documents, one per line."""
    return spark.read.schema(f"{key} ARRAY<STRING>").json(path)


def src_envelope(spark: SparkSession, path: str, category: str | None = None,
                 limit: int | None = None) -> DataFrame:
    """SRC1: postings of a JSON envelope, optional category filter and limit."""
    raw = _as_raw(_records(read_envelope(spark, path, "jobs"), "jobs"))
    if category:
        raw = raw.filter(F.col("category") == category)
    return raw.orderBy("_file", "_line", "_idx").limit(limit) if limit else raw


def first_wins(df: DataFrame, key: Column | str, order: list[Column | str]) -> DataFrame:
    """Keep the first row per key by ``order`` - a partial aggregation.

    ``min_by`` pre-reduces in every map task, so a key repeated in a third of the
    rows is not collected in one reducer.  Each column has one of its own: those
    that a caller does not read are not shuffled.
    """
    key_col = F.col(key) if isinstance(key, str) else key
    ordered = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    return (
        df.withColumns({"_dk": key_col, "_order": ordered})
        .groupBy("_dk")
        .agg(*[F.min_by(c, "_order").alias(c) for c in df.columns])
        .drop("_dk")
    )


def src_category_union(spark: SparkSession, fetch_paths: list[str]) -> DataFrame:
    """SRC2: uncategorised fetch plus one fetch per category; first id wins.

    Records without an id (missing, null or 0) are dropped.
    """
    parts = []
    for order, path in enumerate(fetch_paths):
        recs = _as_raw(_records(read_envelope(spark, path, "jobs"), "jobs"))
        parts.append(recs.withColumn("_fetch", F.lit(order)))
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    idl = F.col("id").try_cast("bigint")
    df = df.filter(F.col("id").isNotNull() & (F.coalesce(idl, F.lit(1)) != 0) & (F.col("id") != ""))
    return first_wins(df, "id", ["_fetch", "_file", "_line", "_idx"])


def _epoch_or_text(v: Column) -> Column:
    """A date field that is either epoch seconds or ISO text."""
    is_num = v.rlike(r"^\d+(\.\d+)?$")
    return F.when(is_num, F.date_format(F.timestamp_seconds(v.cast("double").cast("long")), ISO_UTC)).otherwise(v)


def _tag_list(v: Column) -> Column:
    """A tags field that is a JSON list or a comma-separated string."""
    as_list = F.from_json(v, "array<string>")
    csv = F.filter(F.transform(F.split(v, ",", -1), lambda t: py_strip(t)), lambda t: t != "")
    return F.when(v.isNull() | (v == ""), F.array().cast("array<string>")).when(
        v.startswith("["), F.coalesce(as_list, F.array().cast("array<string>"))).otherwise(csv)


def _truthy(v: Column) -> Column:
    return F.nullif(v, F.lit(""))


REMOTEOK_SCHEMA = ("id STRING, position STRING, title STRING, company STRING, company_logo STRING, "
                   "tags STRING, date STRING, epoch STRING, url STRING, location STRING, salary STRING, "
                   "description STRING")


def norm_remoteok(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: array-of-objects source -> canonical raw postings; ``_idx`` is the byte
    offset in the file, whatever ranges it was read by."""
    df = json_records(spark, path).select(
        "_file", F.col("_offset").alias("_idx"), F.from_json("_rec", REMOTEOK_SCHEMA).alias("j")).select("_file", "_idx", "j.*")
    raw_id = F.regexp_replace(F.col("id"), "^r+", "")
    df = df.filter(_truthy(F.col("id")).isNotNull() & (F.col("id") != "0")).withColumn(
        "_rid", F.when(raw_id.rlike(r"^\d+$"), raw_id.try_cast("bigint"))
    ).filter(F.col("_rid").isNotNull())
    tags = _tag_list(F.col("tags"))
    date = F.coalesce(_truthy(F.col("date")), _truthy(F.col("epoch")))
    return df.select(
        T.stable_id("remoteok", F.col("_rid"), fixed.ID_OFFSET_REMOTEOK).cast("string").alias("id"),
        F.coalesce(_truthy(F.col("url")), F.concat(F.lit(fixed.REMOTEOK_URL_PREFIX), F.col("_rid").cast("string"))).alias("url"),
        F.coalesce(_truthy(F.col("position")), _truthy(F.col("title")), F.lit(fixed.UNKNOWN_ROLE)).alias("title"),
        F.coalesce(_truthy(F.col("company")), F.lit(fixed.UNKNOWN_COMPANY)).alias("company_name"),
        F.col("company_logo"),
        F.try_element_at(tags, F.lit(1)).alias("category"),
        F.to_json(tags).alias("tags"),
        F.lit("full_time").alias("job_type"),
        F.coalesce(_epoch_or_text(date), F.lit(fixed.DEFAULT_PUBLICATION_DATE)).alias("publication_date"),
        F.coalesce(_truthy(F.col("location")), F.lit("Worldwide")).alias("candidate_required_location"),
        F.col("salary"),
        F.col("description"),
        F.lit("remoteok").alias("source"),
        "_file", F.lit(0).cast("long").alias("_line"), "_idx",
    )


ARBEITNOW_SCHEMA = ("slug: STRING, title: STRING, company_name: STRING, company_logo: STRING, "
                    "location: STRING, remote: BOOLEAN, job_types: ARRAY<STRING>, created_at: STRING, "
                    "tags: STRING, url: STRING, description: STRING")


def norm_arbeitnow(spark: SparkSession, path: str) -> DataFrame:
    """SRC4: paged ``{"data": [...]}`` source -> canonical raw postings."""
    pages = spark.read.schema(f"data ARRAY<STRUCT<{ARBEITNOW_SCHEMA}>>").json(path)
    df = pages.select(F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_line"),
                      "data").select("_file", "_line", F.posexplode("data").alias("_idx", "j")).select(
        "_file", "_line", "_idx", "j.*")
    slug = F.coalesce(_truthy(F.col("slug")), F.col("title"), F.lit("unknown"))
    tags = _tag_list(F.col("tags"))
    types = F.col("job_types")
    return df.select(
        T.stable_id("arbeitnow", slug, fixed.ID_OFFSET_ARBEITNOW).cast("string").alias("id"),
        F.coalesce(_truthy(F.col("url")), F.concat(F.lit(fixed.ARBEITNOW_URL_PREFIX), slug)).alias("url"),
        F.coalesce(_truthy(F.col("title")), F.lit(fixed.UNKNOWN_ROLE)).alias("title"),
        F.coalesce(_truthy(F.col("company_name")), F.lit(fixed.UNKNOWN_COMPANY)).alias("company_name"),
        F.col("company_logo"),
        F.try_element_at(tags, F.lit(1)).alias("category"),
        F.to_json(tags).alias("tags"),
        F.when(types.isNull() | (F.size(types) == 0), F.lit("full_time")).otherwise(F.try_element_at(types, F.lit(1))).alias("job_type"),
        F.coalesce(_epoch_or_text(_truthy(F.col("created_at"))), F.lit(fixed.DEFAULT_PUBLICATION_DATE)).alias("publication_date"),
        F.coalesce(_truthy(F.col("location")),
                   F.when(F.coalesce(F.col("remote"), F.lit(False)), F.lit("Remote")).otherwise(F.lit("Worldwide"))
                   ).alias("candidate_required_location"),
        F.lit(None).cast("string").alias("salary"),
        F.col("description"),
        F.lit("arbeitnow").alias("source"),
        "_file", "_line", "_idx",
    )


JSEARCH_SCHEMA = ("job_id: STRING, job_apply_link: STRING, job_google_link: STRING, job_title: STRING, "
                  "employer_name: STRING, employer_logo: STRING, job_category: STRING, "
                  "job_employment_type: STRING, job_posted_at_datetime_utc: STRING, job_country: STRING, "
                  "job_city: STRING, job_min_salary: STRING, job_max_salary: STRING, "
                  "job_salary_currency: STRING, job_description: STRING, "
                  "job_highlights: STRUCT<Qualifications: ARRAY<STRING>>")


def norm_jsearch(spark: SparkSession, query_paths: list[str]) -> DataFrame:
    """SRC5: query-result pages; first occurrence of a job_id wins across queries."""
    parts = []
    for q, path in enumerate(query_paths):
        pages = spark.read.schema(f"data ARRAY<STRUCT<{JSEARCH_SCHEMA}>>").json(path)
        parts.append(pages.select(F.lit(q).alias("_query"), F.col("_metadata.file_path").alias("_file"),
                                  F.monotonically_increasing_id().alias("_line"), "data")
                     .select("_query", "_file", "_line", F.posexplode("data").alias("_idx", "j"))
                     .select("_query", "_file", "_line", "_idx", "j.*"))
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    df = df.filter(F.col("job_id").isNotNull() & (F.col("job_id") != ""))
    df = first_wins(df, "job_id", ["_query", "_file", "_line", "_idx"])
    tags = T.qualification_keywords(F.col("job_highlights.Qualifications"))
    # Salaries are read as their JSON token text, so the text is what
    # Python's f-string would print for the parsed number; 0 and null are falsy.
    smin, smax = F.col("job_min_salary"), F.col("job_max_salary")
    truthy_min = F.coalesce(smin.try_cast("double"), F.lit(0.0)) != 0
    truthy_max = F.coalesce(smax.try_cast("double"), F.lit(0.0)) != 0
    has_sal = truthy_min | truthy_max
    part_min = F.when(truthy_min, smin).otherwise(F.lit(""))
    part_max = F.when(truthy_max, smax).otherwise(F.lit(""))
    salary = F.when(has_sal, F.concat(part_min, F.lit("-"), part_max, F.lit(" "),
                                      F.coalesce(F.col("job_salary_currency"), F.lit("None"))))
    return df.select(
        T.stable_id("jsearch", F.col("job_id"), fixed.ID_OFFSET_JSEARCH).cast("string").alias("id"),
        F.coalesce(_truthy(F.col("job_apply_link")), _truthy(F.col("job_google_link")),
                   F.lit(fixed.JSEARCH_DEFAULT_URL)).alias("url"),
        F.coalesce(_truthy(F.col("job_title")), F.lit(fixed.UNKNOWN_ROLE)).alias("title"),
        F.coalesce(_truthy(F.col("employer_name")), F.lit(fixed.UNKNOWN_COMPANY)).alias("company_name"),
        F.col("employer_logo").alias("company_logo"),
        F.coalesce(_truthy(F.col("job_category")), F.try_element_at(tags, F.lit(1))).alias("category"),
        F.to_json(tags).alias("tags"),
        F.coalesce(_truthy(F.col("job_employment_type")), F.lit("full_time")).alias("job_type"),
        F.coalesce(_truthy(F.col("job_posted_at_datetime_utc")), F.lit(fixed.DEFAULT_PUBLICATION_DATE)).alias("publication_date"),
        F.coalesce(_truthy(F.col("job_country")), _truthy(F.col("job_city")), F.lit("Worldwide")).alias("candidate_required_location"),
        salary.alias("salary"),
        F.col("job_description").alias("description"),
        F.lit("jsearch").alias("source"),
        "_file", "_line", "_idx",
    )


CSV_COLUMNS = [f for f in fixed.CANONICAL_FIELDS if f != "source"]


# A null marker that cannot occur in text: every CSV field reads as a string
# (empty fields as ''), as a Python ``csv.DictReader`` returns them.
_NO_NULL = "\u0000"


def src_csv(spark: SparkSession, path: str) -> DataFrame:
    """SRC8: header CSV, every column text (id checked by validation); ``_idx`` is the
    byte offset in the file, whatever ranges it was read by."""
    schema = ", ".join(f"{c} STRING" for c in CSV_COLUMNS)
    options = {"quote": '"', "escape": '"', "nullValue": _NO_NULL, "emptyValue": ""}
    rows = csv_records(spark, path).select("_file", "_offset", F.from_csv("_rec", schema, options).alias("c"))
    return rows.select(*[F.coalesce(f"c.{c}", F.lit("")).alias(c) for c in CSV_COLUMNS],
                       "_file", F.lit(0).cast("long").alias("_line"), F.col("_offset").alias("_idx"))


def merge_sources(sources: dict[str, DataFrame]) -> DataFrame:
    """SRC9: union by priority, first posting per URL wins.

    Blank or missing URLs are kept (each is its own group) so validation
    dead-letters them instead of dropping them silently.
    """
    parts = []
    for name, df in sources.items():
        prio = fixed.MERGE_PRIORITY.index(name) if name in fixed.MERGE_PRIORITY else len(fixed.MERGE_PRIORITY)
        parts.append(df.withColumn("_prio", F.lit(prio)))
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    key = F.when(F.coalesce(F.col("url"), F.lit("")) == "",
                 F.concat(F.lit("\u0000"), F.col("_prio").cast("string"), F.lit(":"), F.col("_file"),
                          F.lit(":"), F.col("_line").cast("string"), F.lit(":"), F.col("_idx").cast("string"))
                 ).otherwise(F.col("url"))
    return first_wins(df, key, ["_prio", "_file", "_line", "_idx"])


def path_has_data(spark: SparkSession, path: str) -> bool:
    """True when ``path`` exists and holds at least one file (Hadoop FS listing)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return False
    it = fs.listFiles(p, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def source_fallback(spark: SparkSession, primary: Callable[[], DataFrame], primary_path: str,
                    fallback_csv: str, source: str = fixed.DEFAULT_SOURCE) -> tuple[str, DataFrame]:
    """SRC10: the primary source, or the CSV labelled ``kaggle`` when reading it fails.

    A missing or empty folder is a failure, and so is an error while the rows
    are read: they are stored here, so it shows before anything depends on
    them.  Only the default source has a fallback; others raise.
    """
    try:
        if not path_has_data(spark, primary_path):
            raise FileNotFoundError(primary_path)
        return source, materialize(primary())
    except (FileNotFoundError, PySparkException, Py4JJavaError):
        if source != fixed.DEFAULT_SOURCE:
            raise
    return fixed.FALLBACK_SOURCE, src_csv(spark, fallback_csv).withColumn("source", F.lit(fixed.FALLBACK_SOURCE))


# --- fixed values: source names with their own reader ------------------------
RESOLVABLE_SOURCES = ["kaggle", "all", "jsearch"]


def source_resolve(name: str) -> str:
    """SRC11: source name -> reader key (unknown names read the default source)."""
    return name if name in RESOLVABLE_SOURCES else fixed.DEFAULT_SOURCE


def source_resolve_col(name: Column) -> Column:
    """SRC11 as a column expression (for a column of requested source names)."""
    return F.when(name.isin(*RESOLVABLE_SOURCES), name).otherwise(F.lit(fixed.DEFAULT_SOURCE))


def scan_layer(spark: SparkSession, path: str) -> DataFrame:
    """SRC13: a written layer table."""
    return spark.read.parquet(path)
