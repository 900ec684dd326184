"""SimHash near duplicates: fingerprints linked through shards of BK-trees.

A document's fingerprint has a bit set where more than half of the XXH64
hashes of its ``k``-word shingles (repeats included) have it set.  Fingerprints
link at ``radius`` or fewer differing bits; classes are the components.

* Equal fingerprints are collapsed first: one row per distinct fingerprint.
* The 64 bits are cut into blocks.  Two fingerprints within the radius agree in
  all but ``radius`` of the blocks, so they share a shard for at least one choice
  of agreeing blocks: shards lose no link, and fingerprints without any near
  others mostly stand alone in theirs.  More blocks are used for more
  fingerprints, which keeps shards small.
* In a shard a BK-tree is built (children keyed by their Hamming distance to the
  parent) and searched for each of the shard's fingerprints, following only the
  edges within the radius of the distance to the node.  Trees of all shards in a
  task grow and are searched together, in numpy, level by level.
* A shard larger than ``TREE_MAX`` is cut into parts; each part's tree is sent
  to the queries of its own and later parts, so no task holds more than a tree
  and as many queries.  Trees meet only queries of their shard: all trees
  together are the fingerprints of the whole corpus, which must not be broadcast.
* A task returns a spanning forest of the links it found, not the links of a
  dense group, so that copies by the thousand make as many rows as they are.

Defined results: a null, empty or wordless text has fingerprint 0, linked like
any other; 1 to k-1 words are one shingle; repeated rows get the same class; a
null id gets its fingerprint and the smallest id of its class (null if the class
has none); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common as C

SEED = 42
SHARD = 512          # mean size of a shard for which blocks are cut
TREE_MAX = 20_000    # fingerprints in a tree
GROUP = 200_000      # rows of shards that a task works on at once
FRONTIER = 4_000_000  # pairs of query and tree node that may be looked at in one go


# --- fingerprints ---------------------------------------------------------

def _spans(start: np.ndarray, end: np.ndarray, row: np.ndarray, rows: int, k: int):
    """(start, end, row) of the shingles of a block of joined words, by row."""
    n = len(start)
    count = np.bincount(row, minlength=rows)
    short = np.flatnonzero((count > 0) & (count < k))
    begin = np.concatenate([[0], np.cumsum(count)[:-1]])
    a, b, r = start[begin[short]], end[begin[short] + count[short] - 1], short
    if n >= k:
        ok = np.flatnonzero(row[: n - k + 1] == row[k - 1:])
        a, b, r = (np.concatenate(x) for x in ((a, start[ok]), (b, end[ok + k - 1]), (r, row[ok])))
        order = np.argsort(r, kind="stable")
        a, b, r = a[order], b[order], r[order]
    return a, b, r


def _majority(h: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Per row the bits set in more than half of its hashes (sorted by row)."""
    out = np.zeros(rows, C.U)
    if len(h):
        own, first, count = np.unique(row, return_index=True, return_counts=True)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        packed = np.packbits(ones * 2 > count[:, None], axis=1, bitorder="little")
        out[own] = packed.view("<u8").reshape(-1)
    return out


def fingerprints(docs: DataFrame, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) per row; fp is the fingerprint as a signed long."""
    C.small_batches(docs.sparkSession)
    src = C.spread_scan(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            fps = [np.zeros(0, C.U)]
            for lo, hi, buf, off in C.text_blocks(batch.column(1)):
                starts, ends, row = C.word_spans(buf, off)
                joined, starts, ends = C.joined_words(buf, starts, ends)
                a, b, r = _spans(starts, ends, row, hi - lo, k)
                raw = joined.tobytes()
                h = np.fromiter((digest(raw[x:y], SEED) for x, y in zip(a.tolist(), b.tolist())), C.U, len(a))
                fps.append(_majority(h, r, hi - lo))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(fps).view(np.int64))], names=["id", "fp"])

    return src.mapInArrow(run, "id long, fp long")


# --- BK-trees -------------------------------------------------------------

class Forest:
    """BK-trees of many shards, level by level.  ``shard`` must be sorted."""

    def __init__(self, shard: np.ndarray, fp: np.ndarray):
        self.fp = fp
        new = np.ones(len(shard), bool)
        new[1:] = shard[1:] != shard[:-1]
        self.root = np.flatnonzero(new)[np.cumsum(new) - 1]  # of each member
        rest = np.flatnonzero(~new)
        at = self.root[rest]
        codes, children = [], []
        while len(rest):  # one level deeper: the first of each distance becomes the child
            code = at * 65 + np.bitwise_count(fp[rest] ^ fp[at])
            kinds, first, group = np.unique(code, return_index=True, return_inverse=True)
            codes.append(kinds)
            children.append(rest[first])
            stay = np.ones(len(rest), bool)
            stay[first] = False
            at, rest = rest[first][group][stay], rest[stay]
        codes = np.concatenate(codes) if codes else np.zeros(0, np.int64)
        order = np.argsort(codes)
        self.edge = codes[order]  # parent * 65 + distance
        self.child = (np.concatenate(children) if children else codes)[order]

    def search(self, query: np.ndarray, root: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query index, member) pairs within the radius, from the given roots on."""
        qs, nodes = [], []
        q, node = np.arange(len(query)), root
        while len(q):
            d = np.bitwise_count(query[q] ^ self.fp[node]).astype(np.int64)
            near = d <= radius
            qs.append(q[near])
            nodes.append(node[near])
            lo = np.searchsorted(self.edge, node * 65 + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.edge, node * 65 + np.minimum(d + radius, 64), "right")
            size = hi - lo
            begin = np.cumsum(size) - size
            node = self.child[np.arange(size.sum()) + np.repeat(lo - begin, size)]
            q = np.repeat(q, size)
        return np.concatenate([*qs, q]), np.concatenate([*nodes, q])


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after the links a-b: the smallest index of each component."""
    while True:
        x, y = label[a], label[b]
        ne = x != y
        if not ne.any():
            return label
        a, b, x, y = a[ne], b[ne], x[ne], y[ne]
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while not np.array_equal(label[label], label):
            label = label[label]


def _forest_links(cell: np.ndarray, role: np.ndarray, fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the components of the rows of whole cells (sorted)."""
    size = np.unique(cell, return_inverse=True, return_counts=True)
    keep = size[2][size[1]] > 1
    cell, role, fp = cell[keep], role[keep], fp[keep]
    known, at = np.unique(fp, return_inverse=True)
    label = np.arange(len(known))
    member = np.flatnonzero(role & 1)
    asked = np.flatnonzero(role & 2)
    if not len(member) or not len(asked):
        return known[:0], known[:0]
    forest = Forest(cell[member], fp[member])
    place = np.searchsorted(cell[member], cell[asked])
    there = place < len(member)
    there[there] = cell[member][place[there]] == cell[asked][there]
    asked, place = asked[there], place[there]
    root = forest.root[place]
    members = np.bincount(np.searchsorted(cell[member], cell[member], "left"), minlength=len(member))[place]
    cut = np.searchsorted(np.cumsum(members), np.arange(0, members.sum(), FRONTIER), "left")
    for lo, hi in zip(cut, [*cut[1:], len(asked)]):
        q, m = forest.search(fp[asked[lo:hi]], root[lo:hi], radius)
        label = _unite(label, at[asked[lo:hi]][q], at[member][m])
    linked = np.flatnonzero(label != np.arange(len(known)))
    return known[linked], known[label[linked]]


# --- shards ---------------------------------------------------------------

def _masks(count: int, radius: int) -> list[int]:
    """Bit masks of the agreeing blocks; as few blocks as keep shards near SHARD."""
    blocks = radius + 1
    while blocks < 2 * radius + 2 and count > SHARD * 2 ** (64 * (blocks - radius) // blocks):
        blocks += 1
    cut = [64 * i // blocks for i in range(blocks + 1)]
    part = [(1 << cut[i + 1]) - (1 << cut[i]) for i in range(blocks)]
    return [sum(part[i] for i in agree) for agree in combinations(range(blocks), blocks - radius)]


def hamming_links(distinct: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b): links whose components are those of all pairs of ``distinct.fp``
    (signed longs, each once, stored) within the radius."""
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(m)).cast("long")))
            for i, m in enumerate(_masks(distinct.count(), radius))]
    rows = distinct.select("fp", F.explode(F.array(*keys)).alias("shard"))
    large = C.stored(rows.groupBy("shard").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > TREE_MAX)
                     .select("shard", F.ceil(F.col("_n") / TREE_MAX).alias("parts")), "large-shards")
    own = rows.join(large, "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1))) \
        .withColumn("part", F.pmod(F.xxhash64("fp"), "parts"))
    # a row is in the tree of its part and a query of that tree and the earlier ones
    cells = own.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        F.xxhash64("shard", F.least("x", "part"), F.greatest("x", "part")).alias("cell"),
        F.when(F.col("x") == F.col("part"), 3).when(F.col("x") > F.col("part"), 1).otherwise(2).alias("role"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 3
        for batch in chain(batches, [None]):
            if batch is not None:
                held = [np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns)]
            cell = held[0]
            if batch is not None and len(cell) < GROUP:
                continue
            end = len(cell) if batch is None else int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
            if end:
                a, b = _forest_links(cell[:end], held[1][:end], held[2][:end].view(C.U), radius)
                held = [h[end:] for h in held]
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 3, radius: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint, component_id) per row of ``docs``."""
    rows = C.stored(fingerprints(docs, k, id_col, text_col), "fingerprints")
    classes = C.stored(rows.groupBy("fp").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")), "classes")
    links = C.stored(hamming_links(classes.select("fp"), radius), "links")
    found = C.stored(C.components(links), "components")
    named = classes.join(found.select(F.col("id").alias("fp"), "component"), "fp", "left") \
        .withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = C.stored(named.join(least, "component").select("fp", "n", "component_id"), "class-names")
    out = C.join_unique(rows, named, ["fp"], "n", rows.count())
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
