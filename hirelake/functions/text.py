"""Whitespace and text cleansing as built-in column expressions.

Python's ``str.strip``/``str.split`` treat every Unicode space (and the
ASCII separators 0x1C-0x1F) as whitespace, while SQL ``trim`` removes only
the blank.  These helpers use Java regexes in Unicode mode so the result
matches the Python semantics and still runs inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the characters Python's str.isspace() accepts ----------
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_WS = r"[\s\x1c-\x1f]"
_ANY_WS = rf"(?U){_WS}+"


def py_strip(c: Column) -> Column:
    """``str.strip()``: remove leading and trailing Unicode whitespace.

    ``btrim`` with an explicit character set only looks at the two ends, so
    stripping a 20,000-word description costs no more than a short title.
    """
    return F.btrim(c, F.lit(PY_WHITESPACE))


def clean_text(c: Column) -> Column:
    """Optional text field: stripped, blank becomes null (VAL1)."""
    return F.nullif(py_strip(c), F.lit(""))


def collapse_ws(c: Column) -> Column:
    """``" ".join(s.split())``: strip and collapse runs of whitespace (SIL1)."""
    return py_strip(F.regexp_replace(c, _ANY_WS, " "))


def contains_any(c: Column, words: list[str]) -> Column:
    """True when any of ``words`` is a substring of ``c`` (plain, no regex)."""
    cond = F.lit(False)
    for w in words:
        cond = cond | c.contains(w)
    return cond


def present(items: list[Column]) -> Column:
    """The non-null values of ``items`` as an array, in order.

    ``array_except`` against ``[null]`` is code-generated; a lambda
    ``filter`` would evaluate its (possibly expensive) argument interpreted.
    Values must be distinct strings (dictionary terms, labels).
    """
    return F.array_except(F.array(*items), F.array(F.lit(None).cast("string")))
