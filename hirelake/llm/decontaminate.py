"""Benchmark decontamination by the q-gram lemma.

A passage within ``k`` edits of an item of ``m`` characters shares at least
``m + 1 - q (k + 1)`` of its q-grams with it, all within ``k`` diagonals.
Shared q-grams of a text and the items are counted in overlapping bands of
diagonals; bands that reach the bound are regions, and a region is verified by
banded alignment of the whole item.

Characters are lower-cased and runs of white space count as one space; spans
are in code points of the text as given, end exclusive.  The items (a stated
query set) are broadcast in blocks of at most ``ITEMS`` items and ``ITEM_CHARS``
characters, with one pass over the documents for each block.

Items shorter than ``q`` characters allow no edit; they are searched for as they
stand, between characters that are no letters or digits, by an Aho-Corasick
automaton in the same pass.

Defined results: a null or empty text has no match, and a null or blank item none;
equal items each match; repeated rows each match; empty tables give an empty result; an id may be null;
``clean`` keeps all columns of the documents, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from hirelake.llm import common as C

Q = 12            # characters of a q-gram
EDITS = 0.06      # edits allowed per character of an item
ITEMS = 4000
ITEM_CHARS = 2_000_000
_BITS = 22
_B = C.U(0x9E3779B97F4A7C15)


def _folded(text: str) -> np.ndarray:
    """Lower-cased code points, one for each of ``text``."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower()[0] for c in text)
    return np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32)


def _squeezed(cp: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Positions kept when every run of white space within a row becomes one."""
    space = ((cp <= 0x20) & ((cp == 0x20) | ((cp >= 9) & (cp <= 13)) | (cp >= 0x1C))) | (cp == 0x85) | (cp == 0xA0)
    keep = ~space
    if len(keep):
        keep[0] = True
        keep[1:] |= ~space[:-1] | (row[1:] != row[:-1])
    at = np.flatnonzero(keep)
    cp[space] = 0x20
    return at


def _hashes(cp: np.ndarray, q: int) -> np.ndarray:
    """Hash of every run of q code points, by doubling."""
    h, out, done, power = cp.astype(C.U), None, 0, np.array([_B])
    size, rest = 1, q
    while rest:
        if rest & 1:
            out = h if out is None else out[: len(out) - size] * power + h[done: done + len(out) - size]
            done += size
        rest >>= 1
        if rest:
            h = h[: len(h) - size] * power + h[size:] if len(h) > size else h[:0]
            power = power * power
            size *= 2
    return C.mix64(out)


@dataclass(frozen=True)
class Index:
    ids: list
    texts: list[np.ndarray]
    q: int
    edits: np.ndarray    # k of each item
    least: np.ndarray    # shared q-grams that k edits leave
    grams: np.ndarray    # sorted distinct hashes
    cut: np.ndarray      # occurrences of gram g: cut[g] to cut[g + 1]
    item: np.ndarray
    place: np.ndarray
    seen: np.ndarray     # bitmap over the hashes' high bits
    short: list          # places of the items below q characters
    automaton: object    # and the automaton of their texts, None if there are none

    @property
    def longest(self) -> int:
        return max((len(t) for t in self.texts), default=0)


def index(items: list[tuple], q: int = Q, rate: float = EDITS) -> Index:
    """Index of (id, text) items; blank ones are left out."""
    import ahocorasick

    ids, texts = [], []
    for i, t in items:
        cp = _folded((t or "").strip()).copy()
        cp = cp[_squeezed(cp, np.zeros(len(cp), np.int8))]
        if len(cp):
            ids.append(i), texts.append(cp)
    m = np.array([len(t) for t in texts], np.int64)
    short, automaton = np.flatnonzero(m < q).tolist(), ahocorasick.Automaton()
    for i in short:
        word = texts[i].tobytes().decode("utf-32-le", "replace")
        automaton.add_word(word, (*automaton.get(word, ()), i))
    if short:
        automaton.make_automaton()
    k = np.maximum(np.minimum((m * rate).astype(np.int64), m // q - 1), 0)
    hs = [_hashes(t, q) if len(t) >= q else np.zeros(0, C.U) for t in texts]
    h = np.concatenate(hs) if hs else np.zeros(0, C.U)
    item = np.repeat(np.arange(len(texts)), [len(x) for x in hs])
    place = np.concatenate([np.arange(len(x)) for x in hs]) if hs else item
    order = np.argsort(h, kind="stable")
    grams, first = np.unique(h[order], return_index=True)
    seen = np.zeros(1 << _BITS, bool)
    seen[(grams >> C.U(64 - _BITS)).astype(np.int64)] = True
    return Index(ids, texts, q, k, m + 1 - q * (k + 1), grams, np.append(first, len(h)), item[order], place[order],
                 seen, short, automaton if short else None)


def _align(item: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int]:
    """(edits, end): best alignment of all of ``item`` with a stretch of
    ``text`` that begins at ``low`` to ``high``, within that band of diagonals
    (widened by the caller); the first end among equals."""
    width = high - low + 1
    idx = np.arange(width)
    big = len(item) + len(text) + 1
    cost = np.where((low + idx >= 0) & (low + idx <= len(text)), 0, big)
    for i in range(len(item)):
        at = low + i + idx                     # text position compared in this step
        inside = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == item[i]
        step = cost + np.where(inside, np.where(same, 0, 1), big)
        step[:-1] = np.minimum(step[:-1], cost[1:] + 1)        # an item character is missing
        cost = np.minimum.accumulate(step - idx) + idx          # a text character is extra
    end = low + len(item) + idx
    cost = np.where((end >= 0) & (end <= len(text)), cost, big)
    j = int(cost.argmin())
    return int(cost[j]), int(end[j])


def _verify(item: np.ndarray, text: np.ndarray, low: int, high: int, k: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the item in ``text`` near diagonals low..high."""
    a, b = max(0, low - k), min(len(text), high + len(item) + k)
    # the band of zero edits first: the item stands there as it is
    at = text[a:b].tobytes().find(item.tobytes())
    while at % 4 and at >= 0:
        at = text[a:b].tobytes().find(item.tobytes(), at + 1)
    if at >= 0:
        return 0, a + at // 4, a + at // 4 + len(item)
    edits, end = _align(item, text, low - k, high + k)
    if edits > k:
        return None
    back = text[:end][::-1]
    _, length = _align_from(item[::-1], back, k)
    return edits, end - length, end


def _align_from(item: np.ndarray, text: np.ndarray, k: int) -> tuple[int, int]:
    """(edits, end) of ``item`` against ``text`` from its beginning on."""
    width = 2 * k + 1
    idx, big = np.arange(width), len(item) + len(text) + 1
    cost = np.where(idx >= k, idx - k, big)
    for i in range(len(item)):
        at = i - k + idx
        inside = (at >= 0) & (at < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == item[i]
        step = cost + np.where(inside, np.where(same, 0, 1), big)
        step[:-1] = np.minimum(step[:-1], cost[1:] + 1)
        step = np.where(at + 1 == 0, i + 1, step)
        cost = np.minimum.accumulate(step - idx) + idx
    end = len(item) - k + idx
    cost = np.where((end >= 0) & (end <= len(text)), cost, big)
    j = int(cost.argmin())
    return int(cost[j]), int(end[j])


def _words(x: Index, cp: np.ndarray, begin: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(row, item, first, end) of the short items in a block of folded texts."""
    for r in range(len(begin) - 1):
        text = cp[begin[r]: begin[r + 1]].tobytes().decode("utf-32-le", "replace")
        for last, items in x.automaton.iter(text):
            for it in items:
                a = last + 1 - len(x.texts[it])
                if not (a and text[a - 1].isalnum()) and not text[last + 1: last + 2].isalnum():
                    yield r, it, a, last + 1


def _found(x: Index, col: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, start, end, edits) of every match in a column of texts."""
    if not len(x.ids):
        return
    step = 1 << np.ceil(np.log2(x.edits + 1)).astype(np.int64)
    for lo, hi, buf, off in C.text_blocks(col, C.BLOCK_BYTES // 2):
        cut = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])[off]
        cp = _folded(buf.tobytes().decode("utf-8", "replace")).copy()
        row = np.repeat(np.arange(hi - lo), np.diff(cut))
        at = _squeezed(cp, row)
        cp, row = cp[at], row[at]
        begin = np.searchsorted(row, np.arange(hi - lo + 1))
        for r, it, s, e in _words(x, cp, begin) if x.automaton is not None else ():
            yield lo + r, it, int(at[begin[r] + s] - cut[r]), int(at[begin[r] + e - 1] - cut[r] + 1), 0
        if len(cp) < x.q or not len(x.grams):
            continue
        h = _hashes(cp, x.q)
        i = np.flatnonzero(x.seen[(h >> C.U(64 - _BITS)).astype(np.int64)])
        g = np.minimum(np.searchsorted(x.grams, h[i]), len(x.grams) - 1)
        ok = (x.grams[g] == h[i]) & (row[i] == row[i + x.q - 1])
        i, g = i[ok], g[ok]
        if not len(i):
            continue
        many = x.cut[g + 1] - x.cut[g]
        total = np.concatenate([[0], np.cumsum(many)])
        occ = np.repeat(x.cut[g] - total[:-1], many) + np.arange(total[-1])
        i, item = np.repeat(i, many), x.item[occ]
        # rows are set so far apart that no diagonal is shared by two of them
        diag = i - x.place[occ] + (row[i] + 1) * (2 * x.longest)
        band = diag // step[item]
        low = (diag % step[item]) < x.edits[item]   # also at the end of the band before
        pos = np.concatenate([np.arange(len(i)), np.flatnonzero(low)])
        key = (item[pos] << 40) + band[pos] - np.concatenate([np.zeros(len(i), np.int64), np.ones(int(low.sum()), np.int64)])
        order = np.argsort(key, kind="stable")
        key, pos = key[order], pos[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count = np.diff(np.append(first, len(key)))
        found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for f, n in zip(first, count):
            it = int(item[pos[f]])
            if n < x.least[it]:
                continue
            own = pos[f: f + n]
            r = int(row[i[own[0]]])
            d = i[own] - x.place[occ[own]] - begin[r]
            got = _verify(x.texts[it], cp[begin[r]: begin[r + 1]], int(d.min()), int(d.max()), int(x.edits[it]))
            if got:
                found.setdefault((r, it), []).append(got)
        for (r, it), spans in sorted(found.items()):
            taken: list[tuple[int, int]] = []
            for edits, s, e in sorted(set(spans)):
                if all(e <= a or s >= b for a, b in taken):
                    taken.append((s, e))
                    start = at[begin[r] + s] - cut[r]
                    end = at[begin[r] + e - 1] - cut[r] + 1
                    yield lo + r, it, int(start), int(end), edits


def _blocks(items: DataFrame, id_col: str, text_col: str, q: int, rate: float) -> Iterator[Index]:
    """Indexes of bounded blocks of the items."""
    block, chars = [], 0
    for r in items.select(id_col, text_col).toLocalIterator():
        if block and (len(block) >= ITEMS or chars + len(r[1] or "") > ITEM_CHARS):
            yield index(block, q, rate)
            block, chars = [], 0
        block.append((r[0], r[1]))
        chars += len(r[1] or "")
    yield index(block, q, rate)


def matches(docs: DataFrame, items: DataFrame, q: int = Q, rate: float = EDITS, id_col: str = "doc_id",
            text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id_col, item_id, start, end, edits) of every passage of an item."""
    rows = C.spread_scan(docs.select(id_col, F.col(text_col).cast("string").alias("_text")))
    schema = T.StructType([rows.schema[0], T.StructField("item_id", items.schema[item_col].dataType), T.StructField("start", T.LongType()),
                           T.StructField("end", T.LongType()), T.StructField("edits", T.IntegerType())])
    out, id_type = None, to_arrow_type(items.schema[item_col].dataType)
    for block in _blocks(items, item_col, item_text, q, rate):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            x = shared.value
            for b in batches:
                got = list(_found(x, b.column(1)))
                r, it, s, e, n = zip(*got) if got else ((),) * 5
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(r, pa.int64())), pa.array([x.ids[k] for k in it], id_type),
                     pa.array(s, pa.int64()), pa.array(e, pa.int64()), pa.array(n, pa.int32())], names=schema.names)

        part = rows.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, items: DataFrame, q: int = Q, rate: float = EDITS, text_col: str = "text",
          item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no passage of an item, unchanged."""
    out, at = C.spread_scan(docs), docs.columns.index(text_col)
    for block in _blocks(items, item_col, item_text, q, rate):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                keep[[m[0] for m in _found(shared.value, b.column(at))]] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(run, docs.schema)
    return out
