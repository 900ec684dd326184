"""Raw postings and other inputs derived from the driver's star-schema tables.

One raw posting per order ``k``: the order's smallest and largest part and
smallest supplier give title, tags and company; the customer's nation gives
the location; a document gives the description.  Key-based rules plant every
validation and enrichment branch (bad ids and urls, blank titles, all salary
formats, tag formats, locations).  ``hirelake.plans.oracle`` holds the same
rules in DuckDB SQL.

Scale: the only wide operations are one partial aggregation of lineitem by
order key and equi-joins on keys; nation is the only broadcast (25 rows).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.operators.strategy import broadcast_if_small, ensure_parallelism, is_small

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
]

SOURCES_BY_KEY = ["remotive", "remoteok", "arbeitnow", "jsearch"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


# Fields that need a dimension join; all others come from orders alone.
JOINED_FIELDS = {
    "title", "category", "tags", "company_name", "candidate_required_location", "description",
}


def _spread_null(key: str) -> Column:
    """The key, or for a null one of many values that match nothing, so the
    orders without lines do not meet in one task of an outer join."""
    return F.coalesce(F.col(key), -1 - F.pmod(F.xxhash64("o_orderkey"), F.lit(100_000)))


def raw_postings(spark: SparkSession, sf_dir: str, fields: set[str] | None = None) -> DataFrame:
    """Raw postings: all fields as text, plus ``_landed_at`` and ``_pos``.

    ``fields`` names the ``JOINED_FIELDS`` that the caller reads (None: all);
    the others are null and their tables are not read.
    """
    need = JOINED_FIELDS if fields is None else fields & JOINED_FIELDS
    base = ensure_parallelism(table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"))
    if need & {"title", "category", "tags", "company_name"}:
        items = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("p1"), F.max("l_partkey").alias("p2"), F.min("l_suppkey").alias("s1"))
        base = base.join(items, base.o_orderkey == items.l_orderkey, "left")
    part = table(spark, sf_dir, "part")
    if need & {"title", "category", "tags"}:
        p = part.select(F.col("p_partkey").alias("p1"), "p_name", "p_brand", "p_type")
        base = base.withColumn("p1", _spread_null("p1")).join(p, "p1", "left")
    if "tags" in need:
        q = part.select(F.col("p_partkey").alias("p2"), F.col("p_brand").alias("q_brand"), F.col("p_type").alias("q_type"))
        base = base.withColumn("p2", _spread_null("p2")).join(q, "p2", "left")
    if "company_name" in need:
        supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s1"), "s_name")
        base = base.withColumn("s1", _spread_null("s1")).join(supplier, "s1", "left")
    if "candidate_required_location" in need:
        customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        base = base.join(customer, "o_custkey", "left").join(F.broadcast(nation), "c_nationkey", "left")
    if "description" in need:
        base = _with_document(spark, sf_dir, base, "o_orderkey")
    missing = [c for c in ("p_name", "p_brand", "p_type", "q_brand", "q_type", "s_name", "n_name", "_desc")
               if c not in base.columns]
    base = base.withColumns({c: F.lit(None).cast("string") for c in missing})
    return base.select(*_posting_columns())


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_doc"), F.col("text").alias("_desc"))


def _with_document(spark: SparkSession, sf_dir: str, df: DataFrame, key: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    n_docs = docs.select(F.count(F.lit(1))).scalar()
    return df.withColumn("_doc", F.pmod(F.col(key), n_docs)).join(broadcast_if_small(docs), "_doc", "left")


#: Bytes of descriptions that a task should get.
TEXT_PER_TASK = 128 << 20


@dataclass(frozen=True)
class Descriptions:
    """Gives postings their descriptions; ``parts``: tasks that postings are dealt to before."""

    join: Callable[[DataFrame], DataFrame]
    parts: int

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.join(df)


def described_late(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Descriptions | None]:
    """Raw postings, and what gives them their descriptions after they were dealt to
    tasks: texts that are broadcast need not be shuffled with the postings.  Documents too
    large for that are joined at once, and there is nothing left to do (None)."""
    docs = _documents(spark, sf_dir)
    if not is_small(docs):
        return raw_postings(spark, sf_dir), None

    def describe(df: DataFrame) -> DataFrame:
        out = _with_document(spark, sf_dir, df, "_pos").withColumn("description", F.col("_desc"))
        return out.select(*df.columns)

    text = docs.agg(F.coalesce(F.avg(F.octet_length("_desc")), F.lit(0.0))).scalar()
    size = table(spark, sf_dir, "orders").agg(F.ceil(F.count(F.lit(1)) * text / TEXT_PER_TASK).alias("n")).first().n
    parts = max(spark.sparkContext.defaultParallelism, min(size, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    return raw_postings(spark, sf_dir, JOINED_FIELDS - {"description"}), Descriptions(describe, parts)


def _posting_columns() -> list[Column]:
    k = F.col("o_orderkey")
    ks = _s(k)
    cust = F.col("o_custkey")
    a = F.lit(40) + F.pmod(k, F.lit(90))
    b = a + F.lit(10) + F.pmod(k, F.lit(40))
    h = F.lit(15) + F.pmod(k, F.lit(60))
    prio = F.substring("o_orderpriority", 1, 1)
    prefix = (
        F.when(prio == "1", F.lit("Lead "))
        .when(prio == "2", F.lit("Senior  "))
        .when(prio == "4", F.lit("Junior "))
        .otherwise(F.lit(" "))
    )
    title = F.concat(prefix, F.col("p_name"), F.lit(" "), F.col("p_type"), F.lit(" engineer"))
    q = F.lit("'")
    skill = F.upper(F.element_at(
        F.array(*[F.lit(w) for w in fixed.SKILL_KEYWORDS]),
        (F.pmod(k, F.lit(len(fixed.SKILL_KEYWORDS))) + 1).cast("int"),
    ))
    list_text = F.concat(
        F.lit("["), q, F.col("p_brand"), q, F.lit(", "), q, F.col("p_type"), q, F.lit(", "),
        q, F.col("q_brand"), q, F.lit(", "), q, F.lower(F.col("q_type")), q, F.lit(", "),
        q, skill, q, F.lit("]"),
    )
    csv_text = F.concat(
        F.col("p_brand"), F.lit(", "), F.col("p_type"), F.lit(","), F.col("q_brand"),
        F.lit(" ,"), F.col("q_type"), F.lit(", "), skill,
    )
    mod6 = F.pmod(k, F.lit(6))
    salary = (
        F.when(mod6 == 1, F.concat(F.lit("$"), _s(a), F.lit("k - $"), _s(b), F.lit("k")))
        .when(mod6 == 2, F.concat(F.lit("€"), _s(a), F.lit(",000 - €"), _s(b), F.lit(",000")))
        .when(mod6 == 3, F.concat(F.lit("£"), _s(h), F.lit("/hr")))
        .when(mod6 == 4, F.concat(_s(k + 100000), F.lit("-"), _s(k + 140000), F.lit(" USD")))
        .when(mod6 == 5, F.concat(F.lit("$"), _s(a), F.lit("k")))
    )
    location = (
        F.when(F.pmod(cust, F.lit(7)) == 0, F.lit("Worldwide"))
        .when(F.pmod(cust, F.lit(11)) == 0, F.lit(None).cast("string"))
        .when(F.pmod(cust, F.lit(13)) == 0, F.concat(F.col("n_name"), F.lit(",")))
        .when(F.pmod(cust, F.lit(3)) == 0, F.concat(F.lit("Remote, "), F.col("n_name")))
        .otherwise(F.col("n_name"))
    )
    url = (
        F.when(F.pmod(k, F.lit(20)) == 7, F.concat(F.lit("example.com/jobs/"), ks))
        .when(F.pmod(k, F.lit(50)) == 9, F.lit(""))
        .otherwise(F.concat(F.lit("https://example.com/jobs/"), ks))
    )
    source = F.element_at(
        F.array(*[F.lit(s) for s in SOURCES_BY_KEY]), (F.pmod(k, F.lit(4)) + 1).cast("int")
    )
    return [
        ks.alias("id"),
        url.alias("url"),
        title.alias("title"),
        F.col("s_name").alias("company_name"),
        F.lit(None).cast("string").alias("company_logo"),
        F.col("p_type").alias("category"),
        F.when(F.pmod(k, F.lit(3)) == 0, list_text)
        .when(F.pmod(k, F.lit(3)) == 1, csv_text)
        .alias("tags"),
        F.when(F.pmod(k, F.lit(7)) == 0, F.lit("part_time")).otherwise(F.lit("full_time")).alias("job_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publication_date"),
        location.alias("candidate_required_location"),
        salary.alias("salary"),
        F.col("_desc").alias("description"),
        source.alias("source"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("_landed_at"),
        k.alias("_pos"),
    ]


def resumes(spark: SparkSession, sf_dir: str, with_roles: bool = False) -> DataFrame:
    """Résumés: one per document - a headline naming a part and a technology,
    then the whole document text.

    The headline uses part ``doc_id % count(part)`` and dictionary term
    ``doc_id % 21`` so résumés share terms with posting titles and tags.
    ``with_roles`` adds recommended roles: every fifth résumé has the part's type.
    """
    docs = ensure_parallelism(table(spark, sf_dir, "documents"))
    part = table(spark, sf_dir, "part")
    n_parts = part.select(F.count(F.lit(1))).scalar()
    names = part.select(F.col("p_partkey").alias("_pk"), "p_name", *(["p_type"] if with_roles else []))
    tech = F.element_at(
        F.array(*[F.lit(w) for w in fixed.TECH_TERMS]),
        (F.pmod(F.col("doc_id"), F.lit(len(fixed.TECH_TERMS))) + 1).cast("int"),
    )
    return (
        docs.withColumn("_pk", F.pmod(F.col("doc_id"), n_parts))
        .join(names, "_pk", "left")
        .select(
            F.col("doc_id").alias("resume_id"),
            F.concat_ws(" ", F.col("p_name"), tech, F.lit("developer."), F.col("text")).alias("resume_text"),
            *([F.when((F.pmod(F.col("doc_id"), F.lit(5)) == 0) & F.col("p_type").isNotNull(), F.array("p_type"))
               .otherwise(F.array().cast("array<string>")).alias("roles")] if with_roles else []),
        )
    )


def subscription_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subscription change log from ``events``.

    signup = subscribe, error = unsubscribe; skills are the words of the
    part named by ``props.k`` (empty when ``k % 10 = 0``, blank when
    ``k % 10 = 1``), so they overlap with posting terms.
    """
    ev = table(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "error"))
    kk = F.get_json_object("props", "$.k").cast("bigint")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("_k"), "p_name")
    words = F.split(F.col("p_name"), " ", -1)
    skills = (
        F.when(F.pmod(F.col("_k"), F.lit(10)) == 0, F.array().cast("array<string>"))
        .when(F.pmod(F.col("_k"), F.lit(10)) == 1, F.array(F.lit("  ")))
        .otherwise(F.transform(words, lambda w: F.concat(F.lit(" "), F.upper(w))))
    )
    return (
        ev.withColumn("_k", kk)
        .join(part, "_k", "left")
        .select(
            "event_id",
            "ts",
            F.when(F.col("event_type") == "signup", F.lit("subscribe")).otherwise(F.lit("unsubscribe")).alias("action"),
            F.concat(F.lit("  User"), _s(F.col("user_id")), F.lit("@Example.com ")).alias("email"),
            F.concat(F.lit(" user "), _s(F.col("user_id"))).alias("name"),
            skills.alias("skills"),
        )
    )


def bookmark_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookmark change log from ``events``.

    signup = add, error = remove, click = note update; the job id is
    ``props.k * 100 + user_id`` so ids hit existing and missing postings.
    """
    ev = table(spark, sf_dir, "events").filter(F.col("event_type").isin("signup", "error", "click"))
    kk = F.get_json_object("props", "$.k").cast("bigint")
    action = (
        F.when(F.col("event_type") == "signup", F.lit("add"))
        .when(F.col("event_type") == "error", F.lit("remove"))
        .otherwise(F.lit("note"))
    )
    return ev.select(
        "event_id",
        "ts",
        action.alias("action"),
        (kk * 100 + F.col("user_id")).alias("job_id"),
        F.concat(F.lit("note "), _s(F.col("event_id"))).alias("notes"),
    )
