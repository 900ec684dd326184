"""Best-fit packing by a configuration linear program over the length histogram.

A configuration is a multiset of piece lengths that fits into one sequence.
The covering program (fewest configurations that hold every length as often as
it occurs) is solved by multiplicative weights: a length's price falls as it
gets covered, and a knapsack table over the capacity prices, for every length,
the best configuration that holds it.  The fractional solution is rounded to
whole configurations, the rest is solved again, and what a last round leaves
is placed best-fit, largest first.

Only the histogram (at most ``capacity`` numbers) reaches the driver and only
configurations go back; every piece finds its place by its rank among the
pieces of its length.

Defined results: a null or empty text is one piece that holds the end id
alone; a text longer than the capacity is cut, its last piece may be shorter;
repeated rows are packed as often as they come; an empty table gives an empty
result; a null id is kept; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common as C
from hirelake.llm import tokens

SHIFT = 44     # rank bits of a (length, rank) key
SOLVES = 12    # at most so many programs, each over what the last one left
ROUNDS = 3     # weight updates in each
RATE = 2.0     # how fast the price of a covered length falls
LEFT = 0.002   # share of all ids below which the rest is placed best-fit


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, piece, start, length, ids): each text's ids and ``end_id``, cut
    after every ``capacity`` ids; ``ids`` are little-endian unsigned 32-bit."""
    docs = C.spread_scan(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tail = tokens.encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows, piece, start, long, ids, held = [], [], [], [], [], 0
            for i, x in zip(batch.column(0).to_pylist(), enc.texts(batch.column(1))):
                whole = x.astype("<u4", copy=False).tobytes() + tail
                for p, a in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[a: a + 4 * capacity]
                    rows.append(i), piece.append(p), start.append(a // 4), long.append(len(part) // 4), ids.append(part)
                held += len(whole)
                if held > 8 << 20:
                    yield _piece_batch(rows, piece, start, long, ids)
                    rows, piece, start, long, ids, held = [], [], [], [], [], 0
            yield _piece_batch(rows, piece, start, long, ids)

    return docs.mapInArrow(run, "id long, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


def _piece_batch(rows, piece, start, long, ids) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(rows, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
         pa.array(long, pa.int64()), pa.array(ids, pa.binary())], names=["id", "piece", "start", "length", "ids"])


# --- the program ----------------------------------------------------------

def _knapsack(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best value for every capacity, and the length to take there (0: none).
    ``price`` is by length, 0 for lengths that are not wanted."""
    best, take = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        v = price[1: c + 1] + best[c - 1:: -1]
        j = int(v.argmax())
        if v[j] > best[c - 1]:
            best[c], take[c] = v[j], j + 1
        else:
            best[c], take[c] = best[c - 1], take[c - 1] if best[c - 1] else 0
            if take[c]:
                take[c] = -1  # leave one place empty
    return best, take


def _configurations(take: np.ndarray, lengths: np.ndarray, capacity: int) -> list[dict[int, int]]:
    """For every length, the best configuration that holds it."""
    out: list[dict[int, int]] = [{int(n): 1} for n in lengths]
    room = capacity - lengths
    live = np.arange(len(lengths))
    while len(live):
        t = take[room[live]]
        live, t = live[t != 0], t[t != 0]
        room[live] -= np.abs(t)
        for i, n in zip(live[t > 0].tolist(), t[t > 0].tolist()):
            out[i][n] = out[i].get(n, 0) + 1
    return out


def _solve(counts: np.ndarray, capacity: int) -> dict[tuple, float]:
    """Fractional solution: configuration -> how often."""
    lengths = np.flatnonzero(counts)
    need = counts[lengths].astype(float)
    cover, found = np.zeros(len(lengths)), {}
    place = np.zeros(capacity + 1, np.int64)
    place[lengths] = np.arange(len(lengths))
    for r in range(ROUNDS):
        price = np.zeros(capacity + 1)
        price[lengths] = lengths * np.exp(-RATE * (cover / need - cover.sum() / need.sum()))
        _, take = _knapsack(price, capacity)
        step = np.maximum(0.0, need * (r + 1) / ROUNDS - cover)  # what this round should add
        for i, conf in sorted(enumerate(_configurations(take, lengths, capacity)), key=lambda x: -lengths[x[0]]):
            own = place[list(conf)]
            many = np.array(list(conf.values()), float)
            more = min(step[i], float(((need[own] - cover[own]) / many).min()))
            if more > 1e-9:
                cover[own] += more * many
                step[own] -= more * many
                key = tuple(sorted(conf.items(), reverse=True))
                found[key] = found.get(key, 0.0) + more
    return found


def _best_fit(counts: np.ndarray, capacity: int) -> dict[tuple, int]:
    """Best-fit decreasing over a histogram: configuration -> how often.

    Equal sequences are kept together, and all pieces of a length are dealt over a
    group of them at once: a piece that has gone into the tightest sequence makes it
    tighter still, so the next ones follow until it is full.  Work and memory
    depend on the distinct lengths, not on the pieces.
    """
    groups: list[list[tuple[tuple, int]]] = [[] for _ in range(capacity + 1)]  # (configuration, sequences) by room
    open_rooms = np.zeros(capacity + 1, bool)

    def put(conf: tuple, times: int, room: int) -> None:
        groups[room].append((conf, times))
        open_rooms[room] = True

    for n in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[n])
        while left:
            fit = np.flatnonzero(open_rooms[n:])
            if len(fit):
                room = n + int(fit[0])
                conf, times = groups[room].pop()
                open_rooms[room] = bool(groups[room])
            else:
                room, conf, times = capacity, (), left
            most = room // n
            full = min(times, left // most)
            if full:
                put((*conf, (n, most)), full, room - most * n)
            rest = min(left - full * most, most - 1) if full < times else 0
            if rest:
                put((*conf, (n, rest)), 1, room - rest * n)
            if conf and times > full + bool(rest):
                put(conf, times - full - bool(rest), room)
            left -= full * most + rest
    out: dict[tuple, int] = {}
    for group in groups:
        for conf, times in group:
            out[conf] = out.get(conf, 0) + times
    return out


def plan(counts: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Configurations and how often each is used; ``counts`` is by length.

    Together they hold every length exactly as often as it occurs.
    """
    left, out = counts.astype(np.int64).copy(), []
    total = int((left * np.arange(capacity + 1)).sum())
    if left[capacity]:
        out.append((((capacity, 1),), int(left[capacity])))
        left[capacity] = 0
    for _ in range(SOLVES):
        ids = int((left * np.arange(capacity + 1)).sum())
        if ids <= max(LEFT * total, 8 * capacity):
            break
        carry, used = 0.0, 0
        found = _solve(left, capacity)
        fill = {conf: sum(n * m for n, m in conf) for conf in found}
        # sequences with a gap wait for the last step, unless there are no fuller ones
        least = min(capacity, max(fill.values(), default=0)) - capacity // 256
        for conf, x in sorted(found.items(), key=lambda e: (-e[1], e[0])):
            if fill[conf] < least:
                continue
            carry += x
            t = min(int(carry + 1e-9), min(int(left[n]) // m for n, m in conf))
            carry -= int(carry + 1e-9)
            if t > 0:
                for n, m in conf:
                    left[n] -= m * t
                out.append((conf, t))
                used += t
        if not used:
            break
    out.extend(_best_fit(left, capacity).items())
    return out


def _places(confs: list[tuple[tuple, int]], capacity: int) -> dict[str, np.ndarray]:
    """Runs of ranks of a length: key of the first rank, first sequence, copies
    of the length in the configuration, offset of the first copy."""
    used = np.zeros(capacity + 1, np.int64)
    rows, base = [], 0
    for conf, times in confs:
        at = 0
        for n, m in conf:
            rows.append(((n << SHIFT) + int(used[n]), base, m, at))
            used[n] += m * times
            at += n * m
        base += times
    a = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"key": a[:, 0], "base": a[:, 1], "copies": a[:, 2], "offset": a[:, 3]}


def packed(parts: DataFrame, order: list[str], capacity: int = 4096, length_col: str = "length") -> DataFrame:
    """``parts`` (stored rows with a length of 1 to ``capacity``) with
    ``sequence_id`` and ``offset``; offsets have no gap within a sequence."""
    spark = parts.sparkSession
    counts = np.zeros(capacity + 1, np.int64)
    for r in parts.groupBy(length_col).agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r[0]] = r[1]
    places = spark.sparkContext.broadcast(_places(plan(counts, capacity), capacity))
    known = C.ranked(parts, [length_col], order, "_rank")
    schema = known.drop("_rank").schema.add("sequence_id", "long").add("offset", "long")
    names = known.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = places.value
        for batch in batches:
            rank = batch.column(names.index("_rank")).to_numpy().astype(np.int64)
            n = batch.column(names.index(length_col)).to_numpy().astype(np.int64)
            key = (n << SHIFT) + rank
            i = np.searchsorted(p["key"], key, "right") - 1
            turn = key - p["key"][i]
            cols = [batch.column(j) for j, c in enumerate(names) if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(p["base"][i] + turn // p["copies"][i]),
                 pa.array(p["offset"][i] + turn % p["copies"][i] * n)], names=schema.names)

    return known.mapInArrow(run, schema)
