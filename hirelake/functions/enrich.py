"""Silver enrichment functions (SIL1-SIL7) as pure column expressions.

No Python UDFs: each function returns a ``Column`` that Catalyst can fold
into one projection, so the whole bronze -> silver step is a narrow map.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.functions.text import PY_WHITESPACE, collapse_ws, contains_any, py_strip


def normalize_role(title: Column) -> Column:
    """SIL1: strip and collapse whitespace."""
    return collapse_ws(title)


def infer_country(location: Column) -> Column:
    """SIL2: country from a free-text location."""
    loc = py_strip(location)
    low = F.lower(loc)
    last = py_strip(F.element_at(F.split(loc, ",", -1), -1))
    return (
        F.when(location.isNull() | (location == ""), F.lit(fixed.COUNTRY_UNKNOWN))
        .when(low.contains("worldwide") | low.contains("global"), F.lit(fixed.COUNTRY_GLOBAL))
        .when(loc.contains(","), F.coalesce(F.nullif(last, F.lit("")), F.lit(fixed.COUNTRY_UNKNOWN)))
        .otherwise(F.coalesce(F.nullif(loc, F.lit("")), F.lit(fixed.COUNTRY_UNKNOWN)))
    )


def salary_text(salary: Column, description: Column, head_chars: int | None = None) -> Column:
    """Text a salary is read from: the salary field, else the description.

    The whole description by default; ``head_chars`` reads only its head
    (the reference reads ``fixed.DESCRIPTION_SALARY_CHARS``).
    """
    head = description if head_chars is None else F.substring(description, 1, head_chars)
    return F.coalesce(F.nullif(salary, F.lit("")), F.nullif(head, F.lit("")))


def salary_currency_of(text: Column) -> Column:
    """SIL3: EUR / GBP / USD by symbol or code anywhere in the text."""
    up = F.upper(text)
    return (
        F.when(text.contains("€") | up.contains("EUR"), F.lit("EUR"))
        .when(text.contains("£") | up.contains("GBP"), F.lit("GBP"))
        .otherwise(F.lit("USD"))
    )


def salary_is_hourly(text: Column) -> Column:
    """SIL4: an hourly rate is mentioned anywhere (case-insensitive)."""
    return text.rlike("(?iU)" + fixed.HOURLY_PATTERN)


# What ``fixed.SALARY_PATTERN`` matches from the first digit on: the symbol and blanks
# before it are optional there, and so is all after the first one to three digits, so its
# second way to read a number is never tried.
_AMOUNT = r"(?U)\d{1,3}(?:,\d{3})*\s*[kK]?"


def _let(value: Column, body) -> Column:
    """``body(value)``, the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def salary_values(text: Column, hourly: Column | None = None) -> Column:
    """SIL5 core: scaled, range-filtered numbers found in ``text`` (array<double>).

    One regex pass; k-suffix x1000, hourly values below 1000 x2000, then only
    10,000..1,000,000 are kept.
    """
    # Asked once per text that has a value below 1000, not once per such value:
    # a projection of its own would be folded back into the lambda.
    hourly = salary_is_hourly(text) if hourly is None else hourly

    def scale(amount: Column) -> Column:
        base = F.translate(amount, ",kK" + PY_WHITESPACE, "").cast("double")
        return F.when(F.lower(F.substring(amount, -1, 1)) == "k", base * 1000.0).otherwise(base)

    def yearly(values: Column) -> Column:
        return F.when(F.exists(values, lambda v: v < 1000.0) & hourly, F.transform(
            values, lambda v: F.when(v < 1000.0, v * fixed.HOURLY_FACTOR).otherwise(v))).otherwise(values)

    return F.filter(
        _let(F.transform(F.regexp_extract_all(text, F.lit(_AMOUNT), 0), scale), yearly),
        lambda v: (v >= fixed.SALARY_MIN_VALID) & (v <= fixed.SALARY_MAX_VALID),
    )


def salary_from_values(values: Column, text: Column) -> Column:
    """``struct(salary_min, salary_max, salary_currency)`` from computed values."""
    has = F.size(values) > 0
    return F.struct(
        F.when(has, F.array_min(values)).alias("salary_min"),
        F.when(has, F.array_max(values)).alias("salary_max"),
        F.when(has, salary_currency_of(text)).alias("salary_currency"),
    )


def parse_salary(salary: Column, description: Column) -> Column:
    """SIL5 as one expression (for ad-hoc use; ``silver_jobs`` stages it)."""
    return _let(salary_text(salary, description), lambda text: _let(salary_is_hourly(text), lambda hourly: _let(
        salary_values(text, hourly), lambda values: salary_from_values(values, text))))


def seniority_text(title: Column, description: Column) -> Column:
    return F.lower(F.concat(title, F.lit(" "), F.coalesce(description, F.lit(""))))


def seniority_of(text: Column) -> Column:
    """SIL6 on an already lower-cased text."""
    return (
        F.when(contains_any(text, fixed.SENIORITY_LEAD), F.lit("Lead"))
        .when(contains_any(text, fixed.SENIORITY_SENIOR), F.lit("Senior"))
        .when(contains_any(text, fixed.SENIORITY_JUNIOR), F.lit("Junior"))
        .otherwise(F.lit(fixed.SENIORITY_DEFAULT))
    )


def classify_seniority(title: Column, description: Column) -> Column:
    """SIL6: substring keywords on lower(title + ' ' + description)."""
    return seniority_of(seniority_text(title, description))


def published_date(ts: Column) -> Column:
    """SIL7: calendar day in UTC (session time zone is pinned to UTC)."""
    return F.to_date(ts)


def published_month(ts: Column) -> Column:
    """SIL7: first day of the month."""
    return F.trunc(F.to_date(ts), "month")
