"""Cross-tokenizer alignment by merge-path partitioning.

Every text is encoded by two tokenizers, A (byte-level BPE over space + text)
and B (a sentence-piece model, which adds the space itself).  Both token
sequences cover the same bytes, so their alignment is the merge of two sorted
lists of byte ends:

* The merge of a block of texts is cut by diagonals into pieces of equal work;
  a binary search on each diagonal finds how many A and B ends lie before it,
  so pieces are independent of each other.
* A piece emits its overlaps: an A end overlaps the first B token that ends
  there or later, a B end the first A token that ends later.  Equal ends are cuts.
* Cuts of all pieces, those met by a piece's first B end and the last A end of
  the piece before included, are stitched into groups.

The texts are encoded once and their ids stored (two bytes an id).  A second
pass counts in how many documents each id pair is linked (pre-aggregated per
task, summed by a shuffle), a third looks the counts up.  Pairs go to the third
pass as sorted arrays in blocks of at most ``PAIRS`` + one A id's pairs; with more
pairs the stored ids are read once per block.

Ids depend only on the unit a byte stands in; a unit begins at a space between
two characters that are no white space.  No B piece holds a space after another
character (checked on loading), and A's words begin at such a space.  Units are
hashed in numpy and looked up in a cache of fixed size.

Defined results: texts that are null, empty or whose joined A or B bytes differ
from space + text have no tokens: zeros and an empty ``groups_sha256``.  Special
tokens' strings are plain text.  Repeated rows are documents of their own; ids
may be null or repeated; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import itertools
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common as C

SLOTS = 1 << 20        # units the cache can hold
POOL = 8_000_000       # ids the cache can hold; it starts anew when full
WORK = 1 << 16         # steps of the merge in a piece
TOKENS = 1 << 20       # tokens of whole documents that are aligned at once
PAIRS = 2_000_000      # pairs in a block of the count table (24 MB)
FLUSH = 4_000_000      # pairs counted in a task before they are passed on

_RAW = C.mix64(np.arange(1, 257, dtype=C.U) * C._STEP)  # a random number per byte


# --- encoding -------------------------------------------------------------

def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1
    characters stand for themselves, the other bytes for U+0100 and on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(other)}


class Encoder:
    """Ids of both tokenizers for many texts; one per Python worker."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        stand = _byte_of_char()
        vocab = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(stand[c] for c in token) if all(c in stand for c in token) else token.encode()
        piece = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(piece)]
        # no piece goes on with a space: units are encoded independently of each other
        self.units = not any("▁" in p.lstrip("▁") for p in piece)
        self._clear()

    def _clear(self) -> None:
        self.key = np.zeros(SLOTS, C.U)
        self.at = np.zeros(SLOTS, np.int64)
        self.size = np.zeros((2, SLOTS), np.int32)
        self.bad = np.zeros(SLOTS, bool)
        self.pool = np.zeros(POOL, np.uint32)
        self.used = 0

    def whole(self, texts: list[bytes]) -> list[tuple[list[int], list[int], bool]]:
        """(A ids, B ids, whether bytes differ) of texts that begin with a space."""
        plain = [t.decode() for t in texts]
        ids_a = [e.ids for e in self.a.encode_batch_fast(plain, add_special_tokens=False)]
        ids_b = self.b.encode([t[1:] for t in plain], num_threads=1)
        out = []
        for t, a, b in zip(texts, ids_a, ids_b):
            ok = b"".join([self.bytes_a[i] for i in a]) == t and b"".join([self.bytes_b[i] for i in b]) == t
            out.append((a, b, False) if ok else ([], [], True))
        return out

    def _starts(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        """First bytes of the units of a block in which every row begins with a space."""
        if not self.units:
            return off[:-1]
        solid = (buf > 0x20) & (buf < 0x7F)
        two = (buf >= 0xC3) & (buf <= 0xDF)  # first of two bytes, no white space
        before = solid.copy()
        before[1:] |= two[:-1]
        cut = np.zeros(len(buf), bool)
        cut[1:-1] = (buf[1:-1] == 0x20) & before[:-2] & (solid | two)[2:]
        cut[off[:-1]] = True
        last = off[1:] - 1  # a row's last byte is followed by another row's space
        cut[last[last > off[:-1]]] = False
        return np.flatnonzero(cut)

    def block(self, buf: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """[A ids, their offsets by row, B ids, offsets, whether a row has no tokens]."""
        start = self._starts(buf, off)
        end = np.append(start[1:], len(buf))
        up, down = C._powers(len(buf) + 1)
        total = np.zeros(len(buf) + 1, C.U)
        np.cumsum(_RAW[buf] * up[: len(buf)], out=total[1:])
        h = C.mix64((total[end] - total[start]) * down[start] + (end - start).astype(C.U) * C._STEP) | C.U(1)
        slot = (h >> C.U(20)).astype(np.int64) & (SLOTS - 1)
        at, size, bad = self.at[slot], self.size[:, slot].astype(np.int64), self.bad[slot]
        miss = np.flatnonzero(self.key[slot] != h)
        if len(miss):
            new, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
            raw = buf.tobytes()
            got = self.whole([raw[x:y] for x, y in zip(start[miss[first]].tolist(), end[miss[first]].tolist())])
            sizes = np.array([[len(a) for a, _, _ in got], [len(b) for _, b, _ in got]], np.int64)
            flat = np.fromiter(itertools.chain.from_iterable(x for a, b, _ in got for x in (a, b)), np.uint32, int(sizes.sum()))
            if self.used + len(flat) > POOL:
                if len(miss) < len(h):  # begin anew, with all of this block
                    self._clear()
                    return self.block(buf, off)
                self.pool = np.zeros(max(POOL, len(flat)), np.uint32)
                self.key[:], self.used = 0, 0
            both = sizes.sum(axis=0)
            place = self.used + np.cumsum(both) - both
            self.pool[self.used: self.used + len(flat)] = flat
            self.used += len(flat)
            wrong = np.array([x for _, _, x in got], bool)
            s = (new >> C.U(20)).astype(np.int64) & (SLOTS - 1)
            self.key[s], self.at[s], self.size[:, s], self.bad[s] = new, place, sizes, wrong
            at[miss], size[:, miss], bad[miss] = place[back], sizes[:, back], wrong[back]
        row = np.searchsorted(off, start, "right") - 1
        none = np.zeros(len(off) - 1, bool)
        none[row[bad]] = True
        none |= np.diff(off) <= 1  # the added space only
        at = at + np.array([[0], [1]]) * size[0]
        out = []
        for k in range(2):
            n = np.where(none[row], 0, size[k])
            cut = np.concatenate([[0], np.cumsum(n)])
            out += [self.pool[np.repeat(at[k] - cut[:-1], n) + np.arange(cut[-1])], cut[np.searchsorted(row, np.arange(len(off)))]]
        return [*out, none]


@lru_cache(maxsize=1)
def encoder(path_a: str, path_b: str) -> Encoder:
    return Encoder(path_a, path_b)


def _with_space(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every text of a block with a space before it."""
    new = off + np.arange(len(off))
    out = np.full(new[-1], 0x20, np.uint8)
    keep = np.ones(len(out), bool)
    keep[new[:-1]] = False
    out[keep] = buf
    return out, new


def encoded(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, a, b) per row of ``docs``: the ids as little-endian numbers."""
    C.small_batches(docs.sparkSession)
    src = C.spread_scan(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")))
    src = src.select(F.monotonically_increasing_id().alias("row"), "id", "text")
    schema = src.drop("text").schema.add("a", "binary").add("b", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path_a, path_b)
        kinds = [_dtype(len(enc.bytes_a)), _dtype(len(enc.bytes_b))]
        for batch in batches:
            parts: list[list[bytes]] = [[], []]
            for _, _, buf, off in C.text_blocks(batch.column(2)):
                got = enc.block(*_with_space(buf, off))
                for k in range(2):
                    ids, cut = got[2 * k].astype(kinds[k]), got[2 * k + 1]
                    raw = ids.tobytes()
                    w = ids.itemsize
                    parts[k] += [raw[x * w: y * w] for x, y in zip(cut[:-1].tolist(), cut[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(parts[0], pa.binary()), pa.array(parts[1], pa.binary())],
                names=["row", "id", "a", "b"])

    return src.mapInArrow(run, schema)


def _dtype(vocab: int) -> str:
    return "<u2" if vocab <= 1 << 16 else "<u4"


# --- merge path -----------------------------------------------------------

def diagonals(ea: np.ndarray, eb: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): how many A and B ends lie before each cut of the merge into
    pieces of ``work`` steps; of equal ends A's comes first."""
    na, nb = len(ea), len(eb)
    d = np.arange(0, na + nb, work)
    lo, hi = np.maximum(0, d - nb), np.minimum(d, na)
    while (open_ := np.flatnonzero(lo < hi)).size:
        mid = (lo[open_] + hi[open_]) // 2
        first = ea[mid] <= eb[d[open_] - 1 - mid]  # this A end is among the first d
        lo[open_] = np.where(first, mid + 1, lo[open_])
        hi[open_] = np.where(first, hi[open_], mid)
    return np.append(lo, na), np.append(d - lo, nb)


def piece(ea: np.ndarray, eb: np.ndarray, i0: int, i1: int, j0: int, j1: int):
    """(A, B, cut A, cut B): overlapping tokens whose overlap ends in this piece,
    and the tokens that end together.  An A end just before the piece is seen."""
    a, b = ea[i0:i1], eb[j0:j1]
    right = j0 + np.searchsorted(b, a, "left")       # first B token that ends there or later
    above = i0 + np.searchsorted(a, b, "right")      # first A token that ends later
    tie = above > 0
    tie[tie] = ea[above[tie] - 1] == b[tie]
    j = np.arange(j0, j1)
    return (np.concatenate([np.arange(i0, i1), above[~tie]]), np.concatenate([right, j[~tie]]), above[tie] - 1, j[tie])


def overlaps(ea: np.ndarray, eb: np.ndarray, work: int = WORK) -> list[np.ndarray]:
    """[A, B, cut A, cut B] of the whole merge, its pieces stitched."""
    i, j = diagonals(ea, eb, work)
    parts = [piece(ea, eb, *x) for x in zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist())]
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 4


# --- documents ------------------------------------------------------------

class Block:
    """Whole documents, aligned: their tokens one after the other."""

    def __init__(self, ids: list[np.ndarray], off: list[np.ndarray], long: list[np.ndarray]):
        self.ids, self.off, self.rows = ids, off, len(off[0]) - 1
        ends = [np.cumsum(long[k][ids[k]]) for k in range(2)]
        self.a, self.b, self.cut_a, self.cut_b = overlaps(*ends)
        self.doc = np.searchsorted(off[0], self.a, "right") - 1

    def pairs(self, vocab_b: int) -> np.ndarray:
        """pair << 20 | document of every link, sorted."""
        pair = self.ids[0][self.a].astype(np.int64) * vocab_b + self.ids[1][self.b]
        return np.sort(pair << 20 | self.doc)

    def groups(self, cells: list[tuple[np.ndarray, np.ndarray]]) -> list[str]:
        """SHA-256 of every document's groups as text; '' without tokens."""
        na, nb = len(self.ids[0]), len(self.ids[1])
        if not na:
            return [""] * self.rows
        last = [np.zeros(n, bool) for n in (na, nb)]
        last[0][self.cut_a], last[1][self.cut_b] = True, True
        before = [np.concatenate([[0], np.cumsum(x)[:-1]]) for x in last]  # groups before each token
        done_a, done_b = np.sort(self.cut_a) + 1, np.concatenate([[0], np.sort(self.cut_b) + 1])
        at_a = np.arange(na) + done_b[before[0]]   # a group's A tokens, then its B tokens
        at_b = np.arange(nb) + done_a[before[1]]
        width = cells[0][0].shape[1]
        out, size = np.zeros((na + nb, width), np.uint8), np.zeros(na + nb, np.int64)
        for k, at, mark in ((0, at_a, b"|"), (1, at_b, b";")):
            digits, long = cells[k]
            out[at], size[at] = digits[self.ids[k]], long[self.ids[k]]
            out[at, size[at]] = np.where(last[k], mark[0], b","[0])
        flat = out[np.arange(width) <= size[:, None]].tobytes()
        end = np.concatenate([[0], np.cumsum(size + 1)])
        cut = end[self.off[0] + self.off[1]].tolist()
        return [hashlib.sha256(flat[x: y - 1]).hexdigest() if y > x else "" for x, y in zip(cut[:-1], cut[1:])]


def _cells(vocab: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of every id, with room for a mark, and their number."""
    text = [str(i) for i in range(vocab)]
    width = len(text[-1]) + 1
    return (np.frombuffer("".join(t.ljust(width) for t in text).encode(), np.uint8).reshape(-1, width),
            np.array([len(t) for t in text], np.int64))


def _blocks(batch: pa.RecordBatch, long: list[np.ndarray], col: int) -> Iterator[tuple[int, int, Block]]:
    """(first row, end row, block) of stored documents, about TOKENS tokens at a time."""
    ids, off = [], []
    for k in range(2):
        kind = np.dtype(_dtype(len(long[k])))
        buf, cut = C.text_buffer(batch.column(col + k))
        raw = buf[cut[0]: cut[-1]]
        ids.append(np.frombuffer(raw.tobytes(), kind))
        off.append((cut - cut[0]) // kind.itemsize)
    both, lo = off[0] + off[1], 0
    while lo < batch.num_rows:
        hi = min(max(lo + 1, int(np.searchsorted(both, both[lo] + TOKENS, "right")) - 1), lo + (1 << 20) - 1)
        part = [x[o[lo]: o[hi]] for x, o in zip(ids, off)]
        yield lo, hi, Block(part, [o[lo: hi + 1] - o[lo] for o in off], long)
        lo = hi


def pair_counts(rows: DataFrame, long: list[np.ndarray]) -> DataFrame:
    """(pair, n): the documents in which A id ``pair div vocab_b`` and B id
    ``pair mod vocab_b`` are linked."""
    vocab_b = len(long[1])
    shared = rows.sparkSession.sparkContext.broadcast(long)

    def flush(pairs: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        pair, at = np.unique(np.concatenate(pairs), return_inverse=True)
        n = np.bincount(at, weights=np.concatenate(counts), minlength=len(pair)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, held = [], [], 0
        for batch in batches:
            for _, _, block in _blocks(batch, shared.value, 0):
                key = block.pairs(vocab_b)
                key = key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key
                pair, n = np.unique(key >> 20, return_counts=True)
                pairs.append(pair)
                counts.append(n)
                held += len(pair)
                if held >= FLUSH:
                    yield flush(pairs, counts)
                    pairs, counts, held = [], [], 0
        if held:
            yield flush(pairs, counts)

    return rows.select("a", "b").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _scored(rows: DataFrame, long: list[np.ndarray], table: tuple[np.ndarray, np.ndarray, np.ndarray], first: bool) -> DataFrame:
    """Per row the sums over its links found in ``table``; the other columns only on
    the ``first`` pass."""
    vocab_b = len(long[1])
    shared = rows.sparkSession.sparkContext.broadcast((long, table, [_cells(len(x)) for x in long]))
    schema = rows.select("row", "id").schema
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, (pairs, counts, best), cells = shared.value
        for batch in batches:
            out = np.zeros((6, batch.num_rows), np.int64)
            sha: list[str | None] = []
            for lo, hi, block in _blocks(batch, lengths, 2):
                key = block.pairs(vocab_b)
                pair, doc = key >> 20, key & ((1 << 20) - 1)
                at = np.minimum(np.searchsorted(pairs, pair), len(pairs) - 1) if len(pairs) else pair[:0]
                if len(pairs):
                    here = pairs[at] == pair
                    at, doc = at[here], doc[here]
                total = lambda w: np.bincount(doc, weights=w, minlength=hi - lo).astype(np.int64)  # noqa: B023, E731
                if len(at):
                    n = counts[at]
                    out[4, lo:hi] = total(best[at])
                    out[5, lo:hi] = (total(n >> 20) << 20) + total(n & ((1 << 20) - 1))  # exact beyond 2^53
                if first:
                    for k in range(2):
                        out[k, lo:hi] = np.diff(block.off[k])
                    out[2, lo:hi] = np.bincount(np.searchsorted(block.off[0], block.cut_a, "right") - 1, minlength=hi - lo)
                    out[3, lo:hi] = np.bincount(block.doc, minlength=hi - lo)
                    sha += block.groups(cells)
                else:
                    sha += [None] * (hi - lo)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x) for x in out], pa.array(sha, pa.string())],
                                             names=schema.names)

    return rows.select("row", "id", "a", "b").mapInArrow(run, schema)


def _tables(counts: DataFrame, vocab_b: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(pairs, counts, whether highest of its A id) in blocks of bounded size,
    each the pairs of a range of A ids."""
    a = F.expr(f"pair div {vocab_b}")
    top = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("pairs"))
    top = C.stored(top, "highest-counts")  # a row per A id
    sizes = top.select("a", "pairs").toPandas().sort_values("a")
    block = np.cumsum(sizes["pairs"].to_numpy()) // PAIRS
    marked = counts.withColumn("a", a).join(top.select("a", "most"), "a")
    ids = sizes["a"].to_numpy()
    for k in np.unique(block):
        own = ids[block == k]
        got = marked.filter(F.col("a").between(int(own[0]), int(own[-1]))).select(
            "pair", "n", (F.col("n") == F.col("most")).alias("best")).toPandas()
        order = np.argsort(got["pair"].to_numpy())
        yield got["pair"].to_numpy()[order], got["n"].to_numpy()[order], got["best"].to_numpy()[order].astype(np.int64)


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row."""
    enc = encoder(path_a, path_b)
    long = [np.array([len(x) for x in table], np.int64) for table in (enc.bytes_a, enc.bytes_b)]
    rows = C.stored(encoded(docs, path_a, path_b, id_col, text_col), "token-ids", compression="zstd")
    counts = C.stored(pair_counts(rows, long), "pair-counts")
    parts = [_scored(rows, long, table, i == 0) for i, table in enumerate(_tables(counts, len(long[1])))]
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    if not parts:  # no pair at all
        none = np.zeros(0, np.int64)
        parts = [_scored(rows, long, (none, none, none), True)]
    out = parts[0]
    if len(parts) > 1:
        for more in parts[1:]:
            out = out.unionByName(more)
        out = out.groupBy("row").agg(F.first("id").alias("id"), *[F.sum(n).alias(n) for n in names],
                                     F.max("groups_sha256").alias("groups_sha256"))
    return out.select(F.col("id").alias(id_col), *names, "groups_sha256")
