"""Parsing of raw field values: ids, tags and ISO timestamps (VAL3, VAL5, VAL6)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import py_strip

# ISO-8601 shapes ``datetime.fromisoformat`` accepts that Spark's string ->
# timestamp cast parses the same way.  Spark alone would also accept
# ``2026-06`` or a bare ``12:00`` (today), which Python rejects.
_ISO_GUARD = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,6})?)?)?)?"
    r"(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)?$"
)


def parse_long(raw: Column) -> Column:
    """Lenient integer parse of a string, null when not an integer."""
    s = py_strip(raw)
    return F.when(s.rlike(r"^[+-]?\d+$"), s.try_cast("bigint"))


_WEEK = r"^(\d{4})(-W(\d{2})(-([1-7]))?|W(\d{2})([1-7])?)(?=$|[^0-9-])"


def _extended(s: Column) -> Column:
    """Other ISO shapes rewritten to the one of ``_ISO_GUARD``: week dates,
    basic dates and times, any separator, more than six fraction digits."""
    part = lambda i: F.regexp_extract(s, _WEEK, i)
    week = F.concat(part(3), part(6)).try_cast("int")
    day = F.coalesce(F.concat(part(5), part(7)).try_cast("int"), F.lit(1))
    jan4 = F.try_to_timestamp(F.concat(part(1), F.lit("-01-04")), F.lit("yyyy-MM-dd")).cast("date")
    monday = F.date_sub(jan4, F.weekday(jan4))
    from_week = F.date_add(monday, ((week - 1) * 7 + day - 1))
    # week 53 must belong to its year: its Thursday does
    real = (week >= 1) & (F.year(F.date_add(monday, (week - 1) * 7 + 3)) == part(1).try_cast("int"))
    dated = F.when(s.rlike(_WEEK), F.when(real, F.concat(
        F.date_format(from_week, "yyyy-MM-dd"), F.regexp_replace(s, _WEEK, "")))).otherwise(
        F.regexp_replace(s, r"^(\d{4})(\d{2})(\d{2})(?=$|[^0-9])", "$1-$2-$3"))
    timed = F.regexp_replace(dated, r"^(\d{4}-\d{2}-\d{2})[^0-9](?=\d{2})", "$1T")
    timed = F.regexp_replace(timed, r"^(.{10}T\d{2})(\d{2})(\d{2})(?=$|[^0-9:])", "$1:$2:$3")
    timed = F.regexp_replace(timed, r"^(.{10}T\d{2})(\d{2})(?=$|[^0-9:])", "$1:$2")
    return F.regexp_replace(timed, r"([.,]\d{6})\d+", "$1")


def parse_iso_timestamp(raw: Column) -> Column:
    """VAL6: ISO string -> UTC timestamp; naive values are UTC; null if invalid.

    The common shape is cast as it is; only other texts are rewritten first.
    """
    s = F.when(raw.rlike(_ISO_GUARD), raw).otherwise(_extended(raw))
    return F.when(s.rlike(_ISO_GUARD), F.regexp_replace(s, ",", ".").try_cast("timestamp"))


def _dedupe_lower(items: Column) -> Column:
    """strip + lower each item, drop blanks, order-preserving distinct."""
    cleaned = F.transform(items, lambda x: F.lower(py_strip(x)))
    return F.array_distinct(F.filter(cleaned, lambda x: x.isNotNull() & (x != "")))


def normalize_tags(raw: Column) -> Column:
    """VAL5: tags from list text, CSV text or null -> ``array<string>``.

    ``"['a', 'b']"`` is read as a list literal (``from_json`` accepts single
    quotes); when that fails the brackets are stripped and the text is split
    on commas, as is any other text.
    """
    s = py_strip(raw)
    is_list_text = s.startswith("[") & s.endswith("]")
    parsed = F.from_json(s, "array<string>")
    unbracketed = F.split(F.regexp_replace(s, r"^[\[\]]+|[\[\]]+$", ""), ",", -1)
    items = (
        F.when(raw.isNull() | (s == ""), F.array().cast("array<string>"))
        .when(is_list_text & parsed.isNotNull(), parsed)
        .when(is_list_text, unbracketed)
        .otherwise(F.split(s, ",", -1))
    )
    return _dedupe_lower(items)


def normalize_tag_array(tags: Column) -> Column:
    """VAL5 for a value that is already an array."""
    return F.coalesce(_dedupe_lower(tags), F.array().cast("array<string>"))
