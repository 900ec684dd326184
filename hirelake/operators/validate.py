"""Validation and cleansing of raw postings (VAL1-VAL9).

One narrow projection computes every rule as a nullable message column and
``error_message = coalesce(rules in field order)`` - the first failing
field wins, as in a per-record schema validator.  Valid rows and dead
letters are two filters over the same projection, so a job that needs both
writes the projection once (see ``hirelake.plans.jobs``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.functions.parse import normalize_tags, parse_iso_timestamp, parse_long
from hirelake.functions.text import clean_text, py_strip

BRONZE_COLUMNS = [
    "id", "source", "url", "title", "company_name", "company_logo", "category",
    "tags", "job_type", "publication_date", "candidate_required_location",
    "salary", "description", "ingested_at",
]


def _present(df: DataFrame, field: str) -> Column:
    """True when the raw record carried ``field`` as a key."""
    if field not in df.columns:
        return F.lit(False)
    if "_keys" in df.columns:
        return F.coalesce(F.array_contains(F.col("_keys"), F.lit(field)), F.lit(True))
    return F.lit(True)


def _raw(df: DataFrame, field: str) -> Column:
    if field in df.columns:
        return F.col(field).cast("string")
    return F.lit(None).cast("string")


def rule_id(df: DataFrame) -> Column:
    """VAL3: integer > 0."""
    raw = _raw(df, "id")
    parsed = parse_long(raw)
    return (
        F.when(~_present(df, "id"), F.lit(fixed.MSG_MISSING))
        .when(raw.isNull(), F.lit(fixed.MSG_INT_TYPE))
        .when(parsed.isNull(), F.lit(fixed.MSG_INT_PARSE))
        .when(parsed <= 0, F.lit(fixed.MSG_GT_ZERO))
    )


def rule_url(df: DataFrame) -> Column:
    """VAL4: non-empty and starting with http:// or https:// (case-sensitive)."""
    raw = _raw(df, "url")
    url = py_strip(raw)
    return (
        F.when(~_present(df, "url"), F.lit(fixed.MSG_MISSING))
        .when(raw.isNull(), F.lit(fixed.MSG_STR_TYPE))
        .when(url == "", F.lit(fixed.MSG_STR_SHORT))
        .when(~url.rlike("^https?://"), F.lit(fixed.MSG_URL_PREFIX))
    )


def rule_required_text(df: DataFrame, field: str) -> Column:
    """VAL2: title / company_name present and not blank."""
    return (
        F.when(~_present(df, field), F.lit(fixed.MSG_MISSING))
        .when(clean_text(_raw(df, field)).isNull(), F.lit(fixed.MSG_BLANK))
    )


def rule_publication_date(df: DataFrame) -> Column:
    """VAL6: ISO datetime text."""
    raw = _raw(df, "publication_date")
    return (
        F.when(~_present(df, "publication_date"), F.lit(fixed.MSG_MISSING))
        .when(raw.isNull(), F.lit(fixed.MSG_DATE_TYPE))
        .when(
            parse_iso_timestamp(raw).isNull(),
            F.concat(F.lit(fixed.MSG_DATE_PARSE_PREFIX + "'"), raw, F.lit("'")),
        )
    )


def _source_lit(run_source: str | Column) -> Column:
    return run_source if isinstance(run_source, Column) else F.lit(run_source)


def source_value(df: DataFrame, run_source: str | Column) -> Column:
    """VAL7: the run's source only when the key is absent."""
    return F.when(_present(df, "source"), clean_text(_raw(df, "source"))).otherwise(_source_lit(run_source))


def rule_source(df: DataFrame, run_source: str | Column) -> Column:
    return F.when(source_value(df, run_source).isNull(), F.lit(fixed.MSG_STR_TYPE))


def validate(raw: DataFrame, run_source: str | Column = fixed.DEFAULT_SOURCE,
             ingested_at: Column | None = None) -> DataFrame:
    """VAL8: typed canonical columns + ``error_message`` (null when valid).

    Raw columns are kept (prefixed ``raw_``) for the dead-letter payload.
    ``ingested_at`` defaults to the raw ``_landed_at`` column, else the
    current time of the run.
    """
    if ingested_at is None:
        ingested_at = F.col("_landed_at") if "_landed_at" in raw.columns else F.current_timestamp()
    error = F.coalesce(
        rule_id(raw),
        rule_url(raw),
        rule_required_text(raw, "title"),
        rule_required_text(raw, "company_name"),
        rule_publication_date(raw),
        rule_source(raw, run_source),
    )
    typed = [
        parse_long(_raw(raw, "id")).alias("id"),
        source_value(raw, run_source).alias("source"),
        py_strip(_raw(raw, "url")).alias("url"),
        clean_text(_raw(raw, "title")).alias("title"),
        clean_text(_raw(raw, "company_name")).alias("company_name"),
        *[clean_text(_raw(raw, f)).alias(f) for f in ("company_logo", "category")],
        normalize_tags(_raw(raw, "tags")).alias("tags"),
        clean_text(_raw(raw, "job_type")).alias("job_type"),
        parse_iso_timestamp(_raw(raw, "publication_date")).alias("publication_date"),
        *[clean_text(_raw(raw, f)).alias(f) for f in ("candidate_required_location", "salary", "description")],
        ingested_at.cast("timestamp").alias("ingested_at"),
    ]
    raw_cols = [
        _raw(raw, f).alias("raw_" + f) for f in fixed.CANONICAL_FIELDS if f in raw.columns
    ]
    extra = [F.col(c) for c in ("_keys", "_pos", "_file", "_idx", "_landed_at", "_dl_id") if c in raw.columns]
    return raw.select(*typed, error.alias("error_message"), *raw_cols, *extra)


def staged(validated: DataFrame) -> DataFrame:
    """What an ingest run stores of ``validate``'s rows: the raw values, which only dead
    letters are made of, are null in valid rows."""
    failed = F.col("error_message").isNotNull()
    return validated.withColumns({c: F.when(failed, F.col(c)) for c in validated.columns if c.startswith("raw_")})


def valid_rows(validated: DataFrame) -> DataFrame:
    """Bronze rows: the 13 canonical columns plus ``ingested_at``."""
    return validated.filter(F.col("error_message").isNull()).select(*BRONZE_COLUMNS)


def raw_payload(validated: DataFrame, run_source: str | Column) -> Column:
    """Original record as JSON text, nulls kept, ``source`` defaulted.

    Only keys the record carried are written, so a re-read can tell a
    missing key from an explicit null (``json_object_keys``).
    """
    fields = [c for c in validated.columns if c.startswith("raw_")]
    present = {c[4:]: _present(validated, c[4:]).alias(c[4:]) for c in fields}
    pairs = []
    for c in fields:
        name = c[4:]
        value = F.col(c)
        if name == "source":
            value = F.when(present[name], value).otherwise(_source_lit(run_source))
            keep = F.lit(True)
        else:
            keep = _present(validated, name) if "_keys" in validated.columns else F.lit(True)
        pairs.append(F.when(keep, F.struct(F.lit(name).alias("k"), value.alias("v"))))
    if "raw_source" not in validated.columns:
        pairs.append(F.struct(F.lit("source").alias("k"), _source_lit(run_source).alias("v")))
    entries = F.filter(F.array(*pairs), lambda e: e.isNotNull())
    return F.to_json(F.map_from_entries(entries), {"ignoreNullFields": "false"})


def dead_letter_id(run_source: str | Column, origin: Column, nth: Column, payload: Column) -> Column:
    """Reproducible dead-letter key from the record's origin and content.

    ``nth`` tells records apart that are equal in both.  The same landed
    record gets the same key in every run, so a replay adds nothing, and
    another record or file gets another key, so a later run loses nothing.
    """
    text = F.concat_ws("|", _source_lit(run_source), origin, nth.cast("string"), payload)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def dead_letters(validated: DataFrame, run_source: str | Column = fixed.DEFAULT_SOURCE,
                 created_at: Column | None = None) -> DataFrame:
    """VAL8 / SNK2: failures with payload, first error and retry state.

    The origin is the landed file and the place in its envelope, or the given
    row key ``_pos``.  Equal failures of one origin are counted (one partial
    aggregation, so a record that fails a million times is reduced in every
    map task) and numbered; each keeps a row of its own.
    """
    if created_at is None:
        created_at = F.col("_landed_at") if "_landed_at" in validated.columns else F.current_timestamp()
    bad = validated.filter(F.col("error_message").isNotNull())
    if "_file" in bad.columns:
        origin = F.concat_ws("#", "_file", F.col("_idx").cast("string"))
    elif "_pos" in bad.columns:
        origin = F.col("_pos").cast("string")
    else:
        origin = F.lit("")
    same = bad.select(
        _source_lit(run_source).alias("source"), origin.alias("_origin"),
        raw_payload(bad, run_source).alias("raw_data"), "error_message",
        created_at.cast("timestamp").alias("created_at"),
    ).groupBy("source", "_origin", "raw_data", "error_message").agg(
        F.count(F.lit(1)).alias("_n"), F.min("created_at").alias("created_at"))
    return same.withColumn("_nth", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(
        dead_letter_id(F.col("source"), F.col("_origin"), F.col("_nth"), F.col("raw_data")).alias("id"),
        "source", "raw_data", "error_message",
        F.lit(False).alias("resolved"),
        F.lit(0).alias("retry_count"),
        "created_at",
        F.lit(None).cast("timestamp").alias("resolved_at"),
    )


def ingest_summary(validated: DataFrame, run_source: str | Column) -> DataFrame:
    """VAL9: fetched / valid / invalid counts in one aggregation."""
    return validated.agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(F.col("error_message").isNull()).alias("valid"),
        F.count_if(F.col("error_message").isNotNull()).alias("invalid"),
    ).select(
        _source_lit(run_source).alias("source"),
        F.when(F.col("fetched") > 0, F.lit("success")).otherwise(F.lit("empty")).alias("status"),
        "fetched", "valid", "invalid",
    )
