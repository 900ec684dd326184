"""Term extraction used by matching, alerts and source adapters.

All functions are array expressions evaluated per row inside codegen; the
joins that use them live in ``hirelake.operators.matching``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.functions.text import present, py_strip

# (?U): word boundaries follow Unicode letters, as Python's ``re`` does.
_TERM_RE = "(?U)" + fixed.TERM_PATTERN


def title_words(title: Column) -> Column:
    """All ``\\b[a-zA-Z0-9+#\\-.]+\\b`` matches in lower(title)."""
    return F.regexp_extract_all(F.lower(title), F.lit(_TERM_RE), 0)


def job_terms(tags: Column, title: Column) -> Column:
    """SET2: lower(tags) union title words (distinct)."""
    lowered = F.transform(F.coalesce(tags, F.array().cast("array<string>")), F.lower)
    return F.array_union(lowered, F.coalesce(title_words(title), F.array().cast("array<string>")))


def skill_set(skills: Column) -> Column:
    """Subscription skills: strip + lower, drop blanks, distinct."""
    cleaned = F.transform(F.coalesce(skills, F.array().cast("array<string>")), lambda s: F.lower(py_strip(s)))
    return F.array_distinct(F.filter(cleaned, lambda s: s != ""))


def resume_skills(text: Column, max_skills: int | None = None) -> Column:
    """REC1: keyword skills of a résumé by first occurrence; all of them, or the
    first ``max_skills`` (the reference takes ``fixed.RESUME_MAX_SKILLS``)."""
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_TERM_RE), 0))
    stop = F.array(*[F.lit(w) for w in fixed.RESUME_STOPWORDS])
    short = F.array(*[F.lit(w) for w in fixed.SHORT_TERMS_KEPT])
    kept = F.filter(
        tokens,
        lambda t: ~F.array_contains(stop, t) & ((F.length(t) > 1) | F.array_contains(short, t)),
    )
    return kept if max_skills is None else F.slice(kept, 1, max_skills)


def qualification_keywords(quals: Column) -> Column:
    """SRC6: dictionary words in each qualification string, order-preserving distinct."""
    pattern = "(?U)\\b(" + "|".join(fixed.SKILL_KEYWORDS) + ")\\b"
    per_qual = F.transform(
        F.coalesce(quals, F.array().cast("array<string>")),
        lambda q: F.regexp_extract_all(F.lower(q), F.lit(pattern), 1),
    )
    return F.array_distinct(F.flatten(per_qual))


def dictionary_terms(text: Column, terms: list[str] | None = None) -> Column:
    """REC6: dictionary terms found whole-word in lower(text), dictionary order.

    A term made of word characters occurs whole-word exactly when it is one
    of the text's maximal word-character runs, so the text is tokenised once
    (``\\w+``, Unicode, the same word definition ``\\b`` uses) and terms are
    looked up in the distinct tokens.  A multi-word term keeps a regex check,
    run only when a plain substring test has already found it.
    """
    terms = terms or fixed.TECH_TERMS
    low = F.lower(text)
    words = F.array_distinct(F.regexp_extract_all(low, F.lit("(?U)\\w+"), 0))
    hits = []
    for t in terms:
        if re.fullmatch(r"\w+", t):
            hits.append(F.array_contains(words, F.lit(t)))
        else:
            hits.append(low.contains(t) & low.rlike("(?U)\\b" + re.escape(t) + "\\b"))
    return present([F.when(h, F.lit(t)) for h, t in zip(hits, terms)])


def stable_id(namespace: str, key: Column, offset: int) -> Column:
    """SRC7: reproducible namespaced id ``md5-based % 1e9 + offset``.

    The first 15 hex digits of ``md5(namespace:key)`` fit in a signed long.
    """
    digest = F.substring(F.md5(F.concat(F.lit(namespace + ":"), key.cast("string"))), 1, 15)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(fixed.ID_MODULUS)) + F.lit(offset)
