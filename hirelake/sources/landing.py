"""Write table-derived postings in each source's landed shape.

These writers let tests and registered queries exercise the readers of
``hirelake.sources.landed`` on data that grows with the driver's tables.
Pages hold ``page_size`` records (the bounded unit of a landed API
response); records are JSON objects that may omit keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.functions.parse import normalize_tags
from hirelake.sources.testdata import Descriptions

PAGE_SIZE = 100
#: Landed files are packed as they are written; the readers tell by their names.
PACKED = "gzip"
#: Records of a CSV file: a packed file is read by one task.
CSV_FILE_RECORDS = 20_000


def _page(df: DataFrame, page_size: int) -> Column:
    return F.format_string("p%08d", F.floor(F.col("_pos") / page_size).cast("long"))


def record_map(raw: DataFrame, drop_source: Column | None = None, drop_title: Column | None = None) -> Column:
    """A raw posting as ``map<string,string>`` holding only the present keys."""
    entries = []
    for f in fixed.CANONICAL_FIELDS:
        keep = F.lit(True)
        if f == "source" and drop_source is not None:
            keep = ~drop_source
        if f == "title" and drop_title is not None:
            keep = ~drop_title
        entries.append(F.when(keep, F.struct(F.lit(f).alias("k"), F.col(f).alias("v"))))
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull()))


def _dealt(raw: DataFrame, describe: Descriptions | None, *keys: str) -> DataFrame:
    """Postings dealt by ranges of ``keys``.  With ``describe`` they get their descriptions
    after that; as Spark sees the narrow rows only, it is not left to choose how many parts."""
    if describe is None:
        return raw.repartitionByRange(*keys)
    parts = getattr(describe, "parts", None) or int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return describe(raw.repartitionByRange(parts, *keys))


def _paged(raw: DataFrame, page_size: int, *keys: str, describe: Descriptions | None = None) -> DataFrame:
    """Postings with their ``page``, dealt by ranges of ``keys`` in page order.
    Grouping by page keeps them where they are, so whole records are shuffled at most once; they
    are made after the shuffle, whose bounds are found by a pass over the rows before it."""
    return _dealt(raw.withColumn("page", _page(raw, page_size)), describe, *keys)


def _envelope_line(key: str) -> Column:
    """One landed response: ``{"<key>": [record, ...]}`` in record order."""
    recs = F.transform(F.sort_array(F.collect_list(F.struct("_pos", "rec"))), lambda x: x["rec"])
    return F.concat(F.lit('{"' + key + '": ['), F.array_join(recs, ","), F.lit("]}")).alias("value")


def envelope_drops(k: Column) -> tuple[Column, Column]:
    """Records that omit a key: source when k % 10 = 3, title when k % 97 = 5."""
    return F.pmod(k, F.lit(10)) == 3, F.pmod(k, F.lit(97)) == 5


def land_envelopes(raw: DataFrame, path: str, key: str = "jobs", page_size: int = PAGE_SIZE,
                   with_drops: bool = True, describe: Descriptions | None = None) -> None:
    """``{key: [record, ...]}`` per line, pages in file-name order."""
    drop_source, drop_title = envelope_drops(F.col("_pos")) if with_drops else (None, None)
    recs = _paged(raw, page_size, "page", describe=describe).select("page", "_pos", F.to_json(
        record_map(raw, drop_source, drop_title), {"ignoreNullFields": "false"}).alias("rec"))
    pages = recs.groupBy("page").agg(_envelope_line(key))
    pages.sortWithinPartitions("page").select("value").write.mode("overwrite").option("compression", PACKED).text(path)


def land_category_fetches(raw: DataFrame, root: str, page_size: int = PAGE_SIZE,
                          describe: Descriptions | None = None) -> list[str]:
    """Uncategorised fetch (k % 4 != 0) plus one fetch per category (all its records).

    Returns the fetch folders in fetch order; category folders are written
    with ``partitionBy`` and listed by name.
    """
    first = f"{root}/fetch=0000"
    land_envelopes(raw.filter(F.pmod("_pos", F.lit(4)) != 0), first, page_size=page_size, with_drops=False, describe=describe)
    cats = raw.filter(F.col("category").isNotNull()).select(
        F.concat(F.lit("c-"), F.regexp_replace("category", "[^A-Za-z0-9]", "_")).alias("cat"), "*")
    recs = _paged(cats, page_size, "cat", "page", describe=describe).select(
        "cat", "page", "_pos", F.to_json(record_map(cats), {"ignoreNullFields": "false"}).alias("rec"))
    pages = recs.groupBy("cat", "page").agg(_envelope_line("jobs"))
    pages.sortWithinPartitions("cat", "page").select("cat", "value").write.mode("overwrite").partitionBy("cat").option(
        "compression", PACKED).text(f"{root}/by_category")
    return [first, f"{root}/by_category"]


def _tag_array(raw: DataFrame) -> Column:
    return normalize_tags(F.col("tags"))


def land_remoteok(raw: DataFrame, path: str, page_size: int = 1000, describe: Descriptions | None = None) -> None:
    """JSON array files (legal notice first); even keys use epoch dates and list tags."""
    k = F.col("_pos")
    even = F.pmod(k, F.lit(2)) == 0
    tags = _tag_array(raw)
    obj = F.to_json(F.struct(
        F.concat(F.lit("r"), k.cast("string")).alias("id"),
        F.col("title").alias("position"),
        F.col("company_name").alias("company"),
        F.col("company_logo"),
        F.when(even, F.to_json(tags)).otherwise(F.array_join(tags, ", ")).alias("tags"),
        F.when(~even, F.col("publication_date")).alias("date"),
        F.when(even, F.unix_timestamp(F.to_timestamp("publication_date"))).alias("epoch"),
        F.col("url"),
        F.col("candidate_required_location").alias("location"),
        F.col("salary"),
        F.col("description"),
    ), {"ignoreNullFields": "false"})
    recs = _paged(raw, page_size, "page", describe=describe).select("page", "_pos", obj.alias("obj"))
    pages = recs.groupBy("page").agg(
        F.concat(F.lit('[{"legal": "notice"},'),
                 F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_pos", "obj"))), lambda x: x["obj"]), ","),
                 F.lit("]")).alias("value"))
    pages.write.mode("overwrite").partitionBy("page").option("compression", PACKED).text(path)


def land_arbeitnow(raw: DataFrame, path: str, page_size: int = PAGE_SIZE, describe: Descriptions | None = None) -> None:
    """``{"data": [...]}`` pages; some records lack slug, location, url or job types."""
    k = F.col("_pos")
    rec = F.struct(
        F.when(F.pmod(k, F.lit(3)) != 0, F.concat(F.lit("job-"), k.cast("string"))).alias("slug"),
        F.col("title"), F.col("company_name"), F.col("company_logo"),
        F.when(F.pmod(k, F.lit(5)) != 0, F.col("candidate_required_location")).alias("location"),
        (F.pmod(k, F.lit(2)) == 0).alias("remote"),
        F.when(F.pmod(k, F.lit(4)) == 0, F.array().cast("array<string>")).otherwise(F.array(F.col("job_type"))).alias("job_types"),
        F.unix_timestamp(F.to_timestamp("publication_date")).alias("created_at"),
        F.to_json(_tag_array(raw)).alias("tags"),
        F.when(F.pmod(k, F.lit(6)) != 0, F.col("url")).alias("url"),
        F.col("description"),
    )
    recs = _paged(raw, page_size, "page", describe=describe).select("page", "_pos", rec.alias("rec"))
    pages = recs.groupBy("page").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_pos", "rec"))), lambda x: x["rec"]).alias("data"))
    pages.sortWithinPartitions("page").write.mode("overwrite").option("ignoreNullFields", "false").option(
        "compression", PACKED).json(path)


JSEARCH_QUERIES = 3


def land_jsearch(raw: DataFrame, root: str, page_size: int = PAGE_SIZE,
                 describe: Descriptions | None = None) -> list[str]:
    """One folder per query; a record belongs to query k % 3 and also to query 0
    when k % 5 = 0 (a duplicate across queries).  k % 17 = 0 has a blank id."""
    k = F.col("_pos")
    last_tag = F.coalesce(F.lower(F.try_element_at(normalize_tags(F.col("tags")), F.lit(-1))), F.lit("go"))
    skill_sentence = F.concat(F.lit("Experience with "), last_tag, F.lit(" and SQL"))
    rec = F.struct(
        F.when(F.pmod(k, F.lit(17)) == 0, F.lit("")).otherwise(F.concat(F.lit("js-"), k.cast("string"))).alias("job_id"),
        F.when(F.pmod(k, F.lit(6)) != 0, F.col("url")).alias("job_apply_link"),
        F.col("title").alias("job_title"),
        F.col("company_name").alias("employer_name"),
        F.when(F.pmod(k, F.lit(2)) == 0, F.col("category")).alias("job_category"),
        F.col("publication_date").alias("job_posted_at_datetime_utc"),
        F.when(F.pmod(k, F.lit(3)) == 0, F.col("candidate_required_location")).alias("job_country"),
        F.when(F.pmod(k, F.lit(4)).isin(1, 3), F.lit(50000) + k)
        .when(F.pmod(k, F.lit(4)) == 2, F.lit(0).cast("long")).alias("job_min_salary"),
        F.when(F.pmod(k, F.lit(4)).isin(2, 3), F.lit(90000) + k).alias("job_max_salary"),
        F.when(F.pmod(k, F.lit(2)) == 0, F.lit("USD")).otherwise(F.lit("EUR")).alias("job_salary_currency"),
        F.col("description").alias("job_description"),
        F.struct(F.array(skill_sentence, F.coalesce(F.col("title"), F.lit(""))).alias("Qualifications")).alias("job_highlights"),
    )
    folders = []
    for q in range(JSEARCH_QUERIES):
        member = (F.pmod(k, F.lit(JSEARCH_QUERIES)) == q) | ((F.pmod(k, F.lit(5)) == 0) & F.lit(q == 0))
        part = raw.filter(member)
        recs = _paged(part, page_size, "page", describe=describe).select("page", "_pos", rec.alias("rec"))
        pages = recs.groupBy("page").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("_pos", "rec"))), lambda x: x["rec"]).alias("data"))
        folder = f"{root}/query={q:04d}"
        pages.sortWithinPartitions("page").write.mode("overwrite").option("ignoreNullFields", "false").option(
            "compression", PACKED).json(folder)
        folders.append(folder)
    return folders


def land_csv(raw: DataFrame, path: str, describe: Descriptions | None = None) -> None:
    """Header CSV of the canonical columns except source (RFC-4180 quoting)."""
    cols = [f for f in fixed.CANONICAL_FIELDS if f != "source"]
    (_dealt(raw, describe, "_pos").sortWithinPartitions("_pos").select(*cols).write.mode("overwrite")
     .option("compression", PACKED).option("maxRecordsPerFile", CSV_FILE_RECORDS)
     .option("header", True).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
