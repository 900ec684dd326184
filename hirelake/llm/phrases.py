"""Phrase collocation mining with Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), split into pieces at punctuation and line ends
and those into words.  Prefix polynomials over a block of texts give the
fingerprint of every run of 1 to ``max_words`` words by two look-ups:

1. For each length n in turn, the fingerprints of all runs of n words whose
   two runs of n - 1 words are frequent are counted in the map task (chunks of
   bounded size) and summed by a shuffle.  A fingerprint's count is never less
   than that of a phrase that has it, so no frequent phrase is lost.  Which
   fingerprints are frequent goes to the next scan as a bitmap of bounded size;
   its false hits cost shuffled rows only.
2. A last scan takes every occurrence of a frequent fingerprint by its pointer
   (block, first byte, last byte), compares it with the text of the first one
   in its chunk, splits those that differ, and only then materialises the
   phrase.  The shuffle sums by phrase, so collisions cannot change a count.

Texts are never shuffled; what is shuffled grows with the distinct runs of
frequent words.  Scores, cuts and the removal of covered phrases are joins and
aggregations over the frequent phrases; products are decimals.

Defined results: a null text is empty, a null language ``und``; texts without
words, empty tables and phrases below the count give nothing; equal rows count
as often as they occur; other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm import common as C

CHUNK = 1_500_000          # runs counted in a map task before they are passed on
TEXT_CHUNK = 4 << 20       # bytes of text whose frequent runs are materialised at once
BITS_MAX = 27              # the bitmap of frequent fingerprints has at most 2^27 bits (16 MB)
COMPARE = 100_000          # occurrences compared with their first one at once

ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BETWEEN = ENDS.copy()
BETWEEN[[0x20, 0x09]] = True


@dataclass(frozen=True)
class Rule:
    """What is reported; ``cover``: a phrase goes when a longer one that holds it
    occurs at least cover[0] / cover[1] as often."""

    min_count: int = 30
    max_words: int = 4
    cover: tuple[int, int] = (80, 100)
    scale: int = 2_000_000
    top: int = 2000


class Runs:
    """The words of a block of texts and the fingerprints of their runs."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, seeds: np.ndarray):
        starts, ends, self.row = C.word_spans(buf, off, BETWEEN)
        self.piece = np.cumsum(ENDS[buf])[starts] + self.row  # both only grow
        self.text, self.start, self.end = C.joined_words(buf, starts, ends)
        self.seed = seeds[self.row]
        up, self._down = C._powers(len(self.text) + 1)
        self._prefix = np.zeros(len(self.text) + 1, C.U)
        np.cumsum(C._BYTE[self.text] * up[: len(self.text)], out=self._prefix[1:])

    def __len__(self) -> int:
        return len(self.start)

    def fingerprints(self, first: np.ndarray, n: int) -> np.ndarray:
        """Of the runs of ``n`` words from the words ``first`` on."""
        a, b = self.start[first], self.end[first + n - 1]
        h = (self._prefix[b] - self._prefix[a]) * self._down[a] + (b - a).astype(C.U) * C._STEP
        return C.mix64(C.mix64(h) ^ self.seed[first])

    def follow(self, first: np.ndarray, n: int) -> np.ndarray:
        """Those of the words ``first`` from which a run of ``n`` words may be
        frequent: it stays in its piece and both its shorter runs are."""
        if n == 1:
            return np.arange(len(self))
        nxt = np.zeros(len(self) + 1, bool)
        nxt[first] = True  # first: where runs of n - 1 words may be frequent
        first = first[nxt[first + 1]]
        return first[self.piece[first] == self.piece[np.minimum(first + n - 1, len(self) - 1)]]

    def frequent(self, upto: int, filters: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(n, first words, fingerprints) of the runs that pass the filters."""
        first = np.zeros(0, np.int64)
        for n in range(1, upto + 1):
            first = self.follow(first, n)
            fp = self.fingerprints(first, n)
            if n <= len(filters):
                ok = _has(filters[n - 1], fp)
                first, fp = first[ok], fp[ok]
            yield n, first, fp


def _has(bitmap: np.ndarray, fp: np.ndarray) -> np.ndarray:
    at = fp >> C.U(64 - int(len(bitmap) * 8).bit_length() + 1)
    return (bitmap[(at >> C.U(3)).astype(np.int64)] >> (at & C.U(7)).astype(np.uint8)) & 1 == 1


def _source(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    return C.spread_scan(docs.select(F.xxhash64(lang).alias("seed"), lang.alias("lang"),
                                     C.text_or_empty(F.col(text_col).cast("string")).alias("text")))


def _counts(src: DataFrame, n: int, filters: list[np.ndarray]) -> DataFrame:
    """(fp, n): fingerprints of runs of n words and how often they occur."""
    shared = src.sparkSession.sparkContext.broadcast(filters)

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        fp, count = np.unique(np.concatenate(parts), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(count)], names=["fp", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            seeds = batch.column(0).to_numpy().view(C.U)
            for lo, hi, buf, off in C.text_blocks(batch.column(2)):
                *_, (_, _, fp) = Runs(buf, off, seeds[lo:hi]).frequent(n, shared.value)
                parts.append(fp)
                held += len(fp)
                if held >= CHUNK:
                    yield flush(parts)
                    parts, held = [], 0
        if held:
            yield flush(parts)

    return src.mapInArrow(run, "fp long, n long").groupBy("fp").agg(F.sum("n").alias("n"))


def _bitmap(frequent: DataFrame) -> np.ndarray:
    """Bits set at the leading bits of the fingerprints, 16 bits for each of
    them or BITS_MAX; built by an aggregation of at most 2^(BITS_MAX - 6) rows."""
    bits = min(BITS_MAX, max(16, (16 * frequent.count()).bit_length()))
    at = F.shiftrightunsigned("fp", 64 - bits)
    words = frequent.select(at.alias("at")).selectExpr("shiftright(at, 6) as w", "shiftleft(1L, cast(at & 63 as int)) as m")
    got = words.groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got["w"].to_numpy(np.int64)] = got["m"].to_numpy(np.int64)
    return out.view(np.uint8)


def _strings(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    off = np.concatenate([[0], np.cumsum(size)])
    data = text[np.arange(off[-1]) + np.repeat(start - off[:-1], size)]
    return pa.StringArray.from_buffers(len(start), pa.py_buffer(off.astype(np.int32)), pa.py_buffer(data))


def _differ(text: np.ndarray, start: np.ndarray, size: np.ndarray, model: np.ndarray) -> np.ndarray:
    """Whether each occurrence's bytes differ from those that begin at ``model``."""
    out = np.zeros(len(start), bool)
    for i in range(0, len(start), COMPARE):
        s, z, m = start[i: i + COMPARE], size[i: i + COMPARE], model[i: i + COMPARE]
        off = np.concatenate([[0], np.cumsum(z)])
        step = np.arange(off[-1])
        bad = text[step + np.repeat(s - off[:-1], z)] != text[step + np.repeat(m - off[:-1], z)]
        if bad.any():
            out[i + np.searchsorted(off, np.flatnonzero(bad), "right") - 1] = True
    return out


def _materialised(text, fp, start, size, lang) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(phrases, languages, counts) of occurrences, compared with the text."""
    while len(fp):
        _, first, group, count = np.unique(fp, return_index=True, return_inverse=True, return_counts=True)
        model = first[group]
        odd = (size != size[model]) | (lang != lang[model])
        same = np.flatnonzero(~odd & (model != np.arange(len(fp))))
        odd[same[_differ(text, start[same], size[same], start[model[same]])]] = True
        if odd.any():
            count -= np.bincount(group[odd], minlength=len(count))
        yield _strings(text, start[first], size[first]), lang[first], count
        fp, start, size, lang = fp[odd], start[odd], size[odd], lang[odd]


def _phrases(src: DataFrame, rule: Rule, filters: list[np.ndarray]) -> DataFrame:
    """(lang, phrase, f) of the frequent phrases, and ('', all words) per language."""
    shared = src.sparkSession.sparkContext.broadcast(filters)

    def flush(held: list, names: list[str]) -> Iterator[pa.RecordBatch]:
        text = np.concatenate([h[0] for h in held])
        fp, start, size, lang = (np.concatenate([h[i] for h in held]) for i in range(1, 5))
        dictionary = pa.array(names, pa.string())
        for phrase, code, count in _materialised(text, fp, start, size, lang):
            yield pa.RecordBatch.from_arrays([dictionary.take(pa.array(code)), phrase, pa.array(count)],
                                             names=["lang", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_of: dict[str, int] = {}
        words: list[int] = []
        held, size = [], 0
        for batch in batches:
            seeds = batch.column(0).to_numpy().view(C.U)
            coded = batch.column(1).dictionary_encode()
            local = []
            for name in coded.dictionary.to_pylist():
                local.append(code_of.setdefault(name, len(code_of)))
            words += [0] * (len(code_of) - len(words))
            code = np.array(local, np.int64)[coded.indices.to_numpy()]
            for lo, hi, buf, off in C.text_blocks(batch.column(2)):
                runs = Runs(buf, off, seeds[lo:hi])
                for c, k in zip(*np.unique(code[lo:hi][runs.row], return_counts=True)):
                    words[c] += int(k)
                for n, first, fp in runs.frequent(rule.max_words, shared.value):
                    if len(fp):
                        s = runs.start[first]
                        held.append((runs.text if n == 1 else runs.text[:0], fp, size + s,
                                     runs.end[first + n - 1] - s, code[lo:hi][runs.row[first]]))
                    elif n == 1:
                        held.append((runs.text, fp, fp.view(np.int64), fp.view(np.int64), fp.view(np.int64)))
                size += len(runs.text)
                if size >= TEXT_CHUNK:
                    yield from flush(held, list(code_of))
                    held, size = [], 0
        if held:
            yield from flush(held, list(code_of))
        if code_of:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(code_of), pa.string()), pa.array([""] * len(words), pa.string()), pa.array(words, pa.int64())],
                names=["lang", "phrase", "f"])

    return src.mapInArrow(run, "lang string, phrase string, f long").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def frequent_phrases(docs: DataFrame, rule: Rule = Rule(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, phrase, f), exact, of all phrases of 1 to ``max_words`` words that occur
    ``min_count`` times in a language; the phrase '' holds the number of all words."""
    C.small_batches(docs.sparkSession)
    src = _source(docs, text_col, lang_col)
    filters: list[np.ndarray] = []
    for n in range(1, rule.max_words + 1):
        often = C.stored(_counts(src, n, filters).filter(F.col("n") >= rule.min_count).select("fp"), f"runs-{n}")
        filters.append(_bitmap(often))
    out = _phrases(src, rule, filters)
    return C.stored(out.filter((F.col("f") >= rule.min_count) | (F.col("phrase") == "")), "phrases")


def collocations(docs: DataFrame, rule: Rule = Rule(), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases."""
    found = frequent_phrases(docs, rule, text_col, lang_col)
    f = found.filter("phrase <> ''").withColumn("w", F.split("phrase", " "))
    longer = f.filter(F.size("w") >= 2).withColumnRenamed("f", "a")

    def words(first: str, count: str) -> str:
        return f"array_join(slice(w, {first}, {count}), ' ')"

    cuts = longer.select("lang", "phrase", "a", "w", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    cuts = cuts.selectExpr("lang", "phrase", "a", "k", f"{words('1', 'k')} as head", f"{words('k + 1', 'size(w) - k')} as tail")
    part = f.select("lang", "phrase", "f")
    cuts = cuts.join(part.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"]) \
        .join(part.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    score = f"(cast({rule.scale} as decimal(10,0)) * cast(a as decimal(20,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"
    cuts = cuts.withColumn("score", F.expr(score))
    scored = cuts.groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "x.score")

    inner = longer.filter(F.size("w") >= 3).select(
        "lang", "a", "w", F.explode(F.expr("sequence(2, size(w) - 1)")).alias("m"))
    inner = inner.select("lang", "a", "w", "m", F.explode(F.expr("sequence(1, size(w) - m + 1)")).alias("i"))
    inner = inner.selectExpr("lang", f"{words('i', 'm')} as phrase", "a").groupBy("lang", "phrase").agg(F.max("a").alias("over"))
    part_of, whole = rule.cover
    big = "cast({} as decimal(20,0))".format
    kept = scored.join(inner, ["lang", "phrase"], "left").filter(
        f"over is null or {whole} * {big('over')} < {part_of} * {big('a')}")

    total = found.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= rule.top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def oracle_sql(rule: Rule = Rule()) -> str:
    """The same over ``documents`` in DuckDB SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    runs = " UNION ALL ".join(
        f"SELECT lang, {n} AS w, array_to_string(ws[i:i + {n - 1}], ' ') AS phrase "
        f"FROM (SELECT lang, ws, unnest(range(1, len(ws) - {n - 2})) AS i FROM words WHERE len(ws) >= {n})"
        for n in range(1, rule.max_words + 1))
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
total AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM words GROUP BY lang),
f AS (SELECT lang, w, phrase, count(*) AS f FROM ({runs}) GROUP BY ALL HAVING count(*) >= {rule.min_count}),
c AS (SELECT lang, w, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE w >= 2),
cuts AS (SELECT *, unnest(range(1, w)) AS k FROM c),
scored AS (
  SELECT c.lang, c.w, c.phrase, c.a, l.f AS l, r.f AS r, k,
         ({rule.scale}::HUGEINT * c.a) // (l.f::HUGEINT + r.f) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:k], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, max(a) AS over
  FROM (SELECT lang, a, ws, m, unnest(range(1, w - m + 2)) AS i
        FROM (SELECT *, unnest(range(2, w)) AS m FROM c WHERE w >= 3)) GROUP BY ALL),
kept AS (SELECT s.* FROM lowest s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
         WHERE i.over IS NULL OR {rule.cover[1]}::HUGEINT * i.over < {rule.cover[0]}::HUGEINT * s.a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM (
  SELECT k.*, t.n, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM kept k JOIN total t ON t.lang = k.lang) WHERE rank <= {rule.top}"""
