"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups, sorted by size, enter the shard with the tightest remaining capacity
that still holds them; shards stand in a balanced tree keyed by that capacity.
Groups of one size are placed together, so the driver needs only the histogram
of group sizes (at most ``CLASSES`` classes, plus the few groups that are large
against a shard), never the groups.  With a shard count instead of a capacity,
the capacity is the smallest tried that fits the count; groups above the mean
take a shard of their own first, and the others share the rest evenly.

Defined results: a null text counts as empty and has only the overhead; equal
texts form one group, so repeated rows stay together; an empty table gives an
empty result; a null id is kept; extra columns are ignored.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common as C

CLASSES = 1 << 16   # size classes of the histogram
LARGE = 2000        # a group above a shard's mean / LARGE is placed by itself
SHIFT = 40
SLACK = (0, 1e-7, 1e-6, 1e-5, 1e-4, 3e-4, 1e-3, 3e-3, 1e-2, 3e-2, 0.1, 0.3, 1.0)


class _Node:
    __slots__ = ("key", "rank", "left", "right")

    def __init__(self, key, rank):
        self.key, self.rank, self.left, self.right = key, rank, None, None


class RoomTree:
    """Treap of (room, shard): insert, remove, and the least room >= size, all
    in expected logarithmic time."""

    def __init__(self, seed: int = 7):
        self._root, self._draw = None, random.Random(seed).random

    def _split(self, t, key):
        """Keys below ``key``, and the others."""
        if t is None:
            return None, None
        if t.key < key:
            t.right, r = self._split(t.right, key)
            return t, r
        l, t.left = self._split(t.left, key)
        return l, t

    def _join(self, a, b):
        if a is None or b is None:
            return a or b
        if a.rank > b.rank:
            a.right = self._join(a.right, b)
            return a
        b.left = self._join(a, b.left)
        return b

    def add(self, room: int, shard: int) -> None:
        a, b = self._split(self._root, (room, shard))
        self._root = self._join(self._join(a, _Node((room, shard), self._draw())), b)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the tightest (room, shard) with room >= size."""
        a, b = self._split(self._root, (size, -1))
        if b is None:
            self._root = a
            return None
        first = b
        while first.left is not None:
            first = first.left
        low, rest = self._split(b, (first.key[0], first.key[1] + 1))
        del low
        self._root = self._join(a, rest)
        return first.key


def best_fit(items: list[tuple[int, int, int]], capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Place ``items`` (size, class, count), largest first.

    Returns runs (class, first rank, count, shard) and the number of shards.
    After a group entered the tightest shard, that shard is still the tightest
    for its equals, so as many of them as fit go there at once.
    """
    tree, runs, shards = RoomTree(), [], 0
    for size, cls, count in sorted(items, reverse=True):
        if size > capacity:
            raise ValueError(f"a group of {size} exceeds the capacity {capacity}")
        done = 0
        while done < count:
            got = tree.take(size)
            if got is None:
                got, shards = (capacity, shards), shards + 1
            n = min(count - done, got[0] // max(1, size))
            runs.append((cls, done, n, got[1]))
            done += n
            tree.add(got[0] - n * size, got[1])
    return runs, shards


def even(items: list[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Runs over at most ``shards`` shards, by the smallest capacity tried."""
    runs, left, free = [], sorted(items, reverse=True), shards
    while left and free > 1:
        size, cls, count = left[0]
        if size * free <= sum(s * c for s, _, c in left):
            break
        n = min(count, free - 1)  # larger than the mean: a shard of its own
        runs += [(cls, i, 1, shards - free + i) for i in range(n)]
        free -= n
        left = ([(size, cls, count - n)] if count > n else []) + left[1:]
        if count > n:
            break
    total = sum(s * c for s, _, c in left)
    if not left:
        return runs
    shift = {cls: sum(n for k, _, n, _ in runs if k == cls) for cls in {r[0] for r in runs}}
    least = max(-(-total // free), left[0][0])
    for slack in SLACK:
        more, used = best_fit(left, int(least * (1 + slack)) + bool(slack))
        if used <= free:
            return runs + [(k, a + shift.get(k, 0), n, shards - free + s) for k, a, n, s in more]
    raise ValueError("no capacity fits the shard count")


def sharded(docs: DataFrame, shards: int | None = 24, capacity: int | None = None, overhead: int = 8,
            id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, size, text_crc32, group_rows, shard, slot) per row.

    With ``capacity`` the number of shards is minimised; otherwise ``shards``
    are filled evenly.  ``slot`` has no gap within a shard.
    """
    spark = docs.sparkSession
    body = C.text_or_empty(text_col)
    rows = C.stored(docs.select(
        F.col(id_col), (F.octet_length(body) + overhead).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"), F.xxhash64(body).alias("_h")), "sizes")
    key = ["size", "text_crc32", "_h"]
    groups = C.stored(
        rows.groupBy(*key).agg(F.count(F.lit(1)).alias("group_rows"))
        .withColumn("_all", F.col("size") * F.col("group_rows")), "groups")
    total, rows_n = groups.agg(F.sum("_all"), F.sum("group_rows")).first()
    if not rows_n:
        return rows.drop("_h").withColumns({
            "group_rows": F.lit(0).cast("long"), "shard": F.lit(0), "slot": F.lit(0).cast("long")})
    large = max(CLASSES, (capacity or -(-total // shards)) // LARGE)
    width = -(-large // CLASSES)
    # a class is a range of small sizes, or one exact large size
    groups = groups.withColumn("_class", F.when(F.col("_all") < large, F.floor(F.col("_all") / width))
                               .otherwise(F.col("_all") + CLASSES).cast("long"))
    items = [(-(-r.b // r.n), r._class, r.n) for r in
             groups.groupBy("_class").agg(F.count(F.lit(1)).alias("n"), F.sum("_all").alias("b")).collect()]
    runs = best_fit(items, capacity)[0] if capacity else even(items, shards)
    names = np.array(sorted({r[0] for r in runs}), np.int64)
    place = np.array(sorted(((int(np.searchsorted(names, c)) << SHIFT) + a, s) for c, a, _, s in runs), np.int64)
    known = spark.sparkContext.broadcast((names, place))
    known_groups = C.ranked(groups, ["_class"], key, "_rank").select(*key, "group_rows", "_class", "_rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, place = known.value
        for b in batches:
            at = (np.searchsorted(names, b.column(4).to_numpy()) << SHIFT) + b.column(5).to_numpy()
            shard = place[np.searchsorted(place[:, 0], at, "right") - 1, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array(shard.astype(np.int32))], names=[*key, "group_rows", "shard"])

    placed = C.stored(known_groups.mapInArrow(run, "size long, text_crc32 long, _h long, group_rows long, shard int"),
                      "placed-groups")
    placed = placed.withColumn("_n", F.col("group_rows"))
    out = C.stored(C.join_unique(rows, placed, key, "_n", rows_n), "placed")
    return C.ranked(out, ["shard"], [id_col, "_h"], "slot").drop("_h")
