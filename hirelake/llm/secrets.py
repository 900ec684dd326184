"""Secret scans over an incremental blob ledger, in DataFrame functions only.

Every version of every text is addressed by its SHA-256.  The ledger is a
Parquet folder with one row per (blob, rule version) that was ever scanned and
its findings.  A scan takes the blobs that the ledger lacks for the current
rules, finds each kind's leftmost non-overlapping matches, appends them, and
joins the findings back to all rows that hold the blob.

Positions come from splitting a text at a kind's pattern: the pieces between
the matches and the matches themselves, summed up, give every start.

Defined results: a null text is the empty blob; an empty text, and one without
matches, has no spans; repeated rows come back as often as they came; an empty
table gives an empty result; a null id is an id like any other; columns beyond
the id and the text are ignored by ``scan`` and kept by ``redacted``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.llm import common as C

MASK = "[SECRET]"
SPANS = "array<struct<start:int,place:int,end:int,kind:string>>"


@dataclass(frozen=True)
class Kind:
    """A pattern, the group whose length counts, the least length, and literals
    of which a matching text holds one."""

    name: str
    pattern: str
    group: int
    least: int
    hints: tuple[str, ...] = ()


# The base kinds, in the order in which ties are listed.
KINDS = (
    Kind("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""",
         2, 6, (":", "=")),
    Kind("access", r"(AKIA[A-Z0-9]+)", 1, 20, ("AKIA",)),
    Kind("hex", r"([0-9a-f]{24,})", 1, 24),
)


def rule_version(kinds: tuple[Kind, ...] = KINDS) -> str:
    return hashlib.sha256(repr(kinds).encode()).hexdigest()[:16]


def _may_match(text: Column, kind: Kind) -> Column:
    hit = text.rlike(kind.pattern)
    if kind.hints:
        some = F.lit(False)
        for h in kind.hints:
            some = some | text.contains(h)
        return some & hit
    return hit


def _spans(blobs: DataFrame, kinds: tuple[Kind, ...]) -> DataFrame:
    """(blob, spans) of blobs (blob, text, is_<kind>) with at least one span."""
    parts = []
    for place, k in enumerate(kinds):
        found = F.regexp_extract_all("text", F.lit(k.pattern), F.lit(0))
        group = F.regexp_extract_all("text", F.lit(k.pattern), F.lit(k.group))
        cut = F.split("text", k.pattern, -1)
        parts.append(
            blobs.filter(F.col(f"is_{k.name}"))
            .select("blob", F.transform(found, F.length).alias("long"), F.transform(group, F.length).alias("group"),
                    F.transform(cut, F.length).alias("gap"))
            .select("blob", F.posexplode(F.arrays_zip("long", "group", F.slice("gap", F.lit(1), F.size("long")).alias("gap"))))
            .select("blob", F.lit(place).alias("place"), F.lit(k.name).alias("kind"), F.lit(k.least).alias("least"),
                    "pos", "col.*"))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    w = Window.partitionBy("blob", "place").orderBy("pos")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("long")).over(w).cast("int"))
    rows = rows.filter(F.col("group") >= F.col("least"))
    span = F.struct((F.col("end") - F.col("long")).alias("start"), "place", "end", "kind")
    return rows.groupBy("blob").agg(F.array_sort(F.collect_list(span)).cast(SPANS).alias("spans"))


def ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger's rows (blob, version, spans), None before the first scan."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.schema(f"blob binary, version string, spans {SPANS}").parquet(path)


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def update(texts: DataFrame, path: str, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Scan the blobs of ``texts`` that the ledger at ``path`` lacks; the
    findings (blob, spans) of the current rules, blobs without any left out.

    The literal and pattern tests run where the text is read, so only texts
    that may hold a secret are shuffled.  A scan that is run again after a
    failure appends nothing twice: what was committed is no longer unseen.
    """
    spark, version = texts.sparkSession, rule_version(kinds)
    rows = texts.select(C.text_or_empty(text_col).alias("text")).withColumn("blob", blob_of(F.col("text")))
    seen = ledger(spark, path)
    if seen is not None:
        seen = seen.filter(F.col("version") == version).select("blob")
        unseen = rows.select("blob").distinct().join(seen, "blob", "left_anti")
        rows = rows.join(unseen, "blob", "left_semi")
    for k in kinds:
        rows = rows.withColumn(f"is_{k.name}", _may_match(F.col("text"), k))
    some = F.lit(False)
    for k in kinds:
        some = some | F.col(f"is_{k.name}")
    flags = [f"is_{k.name}" for k in kinds]
    blobs = C.stored(
        rows.withColumn("text", F.when(some, F.col("text"))).groupBy("blob")
        .agg(F.first("text").alias("text"), *[F.first(f).alias(f) for f in flags]), "unseen-blobs")
    new = blobs.select("blob").join(_spans(blobs.filter("text is not null"), kinds), "blob", "left")
    new.select("blob", F.lit(version).alias("version"), F.coalesce("spans", F.array().cast(SPANS)).alias("spans")) \
        .write.mode("append").parquet(path)
    found = ledger(spark, path).filter((F.col("version") == version) & (F.size("spans") > 0)).select("blob", "spans")
    return found.dropDuplicates(["blob"])  # scans that overlapped have appended a blob twice


def scan(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
         kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """(id_col, spans) per row of ``docs``: start, end (code points, end
    exclusive) and kind, by start, then by the order of ``kinds``."""
    found = update(docs, path, text_col, kinds)
    paths = C.stored(docs.select(F.col(id_col), blob_of(C.text_or_empty(text_col)).alias("blob")), "paths")
    held = found.join(paths.groupBy("blob").agg(F.count(F.lit(1)).alias("rows")), "blob")
    joined = C.join_unique(paths, held, ["blob"], "rows", paths.count(), how="left")
    return joined.select(id_col, F.coalesce("spans", F.array().cast(SPANS)).alias("spans"))


def redacted(docs: DataFrame, path: str, text_col: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with every span, and overlapping spans together, replaced by MASK."""
    found = update(docs, path, text_col, kinds).withColumnRenamed("spans", "_spans")
    some = F.lit(False)
    for k in kinds:
        some = some | _may_match(C.text_or_empty(text_col), k)
    rows = docs.filter(some).withColumn("_blob", blob_of(C.text_or_empty(text_col)))
    rows = rows.join(found.withColumnRenamed("blob", "_blob"), "_blob", "left")  # by a shuffle of these texts only
    t = f"`{text_col}`"
    clean = F.expr(f"""
        aggregate(_spans, struct(0 as pos, '' as done),
          (a, s) -> if(s.start >= a.pos,
            struct(s.end as pos, concat(a.done, substring({t}, a.pos + 1, s.start - a.pos), '{MASK}') as done),
            struct(greatest(a.pos, s.end) as pos, a.done as done)),
          a -> concat(a.done, substring({t}, a.pos + 1, length({t}))))""")
    masked = rows.withColumn(text_col, F.when(F.col("_spans").isNotNull(), clean).otherwise(F.col(text_col)))
    names = [f"`{c}`" for c in docs.columns]
    return masked.select(*names).unionByName(docs.filter(~some).select(*names))


def listed(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def _sql_kind(place: int, kind: Kind, pattern: str) -> str:
    p = pattern.replace("'", "''")
    return (f"SELECT doc_id, {place} AS place, '{kind.name}' AS kind, {kind.least} AS least, "
            f"regexp_extract_all(t, '{p}', 0) AS hits, regexp_extract_all(t, '{p}', {kind.group}) AS parts, "
            f"string_split_regex(t, '{p}') AS gaps FROM d WHERE regexp_matches(t, '{p}')")


def oracle_sql() -> str:
    """DuckDB SQL of the per-document digest (its patterns name both cases)."""
    both = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    words = "|".join(both(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
    patterns = (rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", KINDS[1].pattern, KINDS[2].pattern)
    kinds = " UNION ALL ".join(_sql_kind(i, k, p) for i, (k, p) in enumerate(zip(KINDS, patterns)))
    counts = ", ".join(f"count(*) FILTER (kind = '{k.name}') AS n_{k.name}" for k in KINDS)
    zeros = ", ".join(f"coalesce(n_{k.name}, 0) AS n_{k.name}" for k in KINDS)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
h AS ({kinds}),
x AS (SELECT doc_id, place, kind, least, unnest(hits) AS hit, unnest(parts) AS part,
             unnest(gaps[1:len(hits)]) AS gap, unnest(range(len(hits))) AS i FROM h),
y AS (SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, place ORDER BY i) AS stop FROM x),
z AS (SELECT doc_id, {counts},
        string_agg(kind || ':' || CAST(stop - length(hit) AS BIGINT) || ':' || CAST(stop AS BIGINT), ','
                   ORDER BY stop - length(hit), place) AS s
      FROM y WHERE length(part) >= least GROUP BY doc_id)
SELECT d.doc_id, {zeros}, sha256(coalesce(s, '')) AS base_sha256, coalesce(s, '') AS spans
FROM d LEFT JOIN z USING (doc_id)"""
