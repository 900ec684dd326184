"""Keyed tables with merge-on-read upserts and a change feed (SNK1, STR1, STR2).

A version names its data files with the range of keys and the level of each:
level 0 are base files, in which every key stands once; an upsert adds files of
its own level, its version number, and leaves all others as they are.  The
row of a key is that of the highest level.

* ``upsert`` folds the batch (last row of a key wins), writes it sorted by key,
  and reads of the table only the files whose key range meets one of the batch's
  files, to carry the ``keep_first`` columns over; with such columns, a row that is
  stored as it is already is not written again.
* ``read`` passes on base files whose range meets no upsert; of the others the
  rows of upserted keys are dropped (an anti join against the keys of the
  upserts, broadcast by Spark while they are small).
* ``changes`` gives the rows of all keys upserted between two versions, before
  and after, again reading only files that meet their ranges.
* ``compact`` merges the upserts with the base files they meet; the other base
  files are carried over by name.
* Writers commit through ``manifest``; the loser of a race reads again and
  retries.

Keys must not be null (checked where a batch is folded) and must order alike in
Python and Spark: integers or strings.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.operators.strategy import ROWS_PER_SALT, dematerialize, materialize, shuffles_removed, source_bytes
from hirelake.plans import manifest as M

RETRIES = 20
MAX_LEVELS = 8   # upserts before they are merged into the base
KEEP = 20        # versions kept for readers and the change feed
SLICE_BYTES = 32 << 20  # stored bytes whose rows are shuffled at once, while that makes
MAX_SLICES = 4          # no more passes over them than these

Ranges = list[tuple]


def _meets(file: dict, ranges: Ranges) -> bool:
    """Whether the file's key range meets one of the sorted, disjoint ranges."""
    i = bisect_right([low for low, _ in ranges], file["high"]) - 1
    return i >= 0 and ranges[i][1] >= file["low"]


def _joined(ranges: Ranges) -> Ranges:
    """The ranges sorted, overlapping ones united."""
    out: list[list] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return [tuple(x) for x in out]


def _ranges(files: list[dict]) -> Ranges:
    return _joined([(f["low"], f["high"]) for f in files])


def _slices(pieces: list[tuple], n: int) -> list[tuple]:
    """At most ``n`` key ranges (after the first key, up to the second; None: no bound) that
    hold about as many of the (low, high, rows) pieces' rows each."""
    pieces = sorted(pieces, key=lambda p: p[1])
    total, ends, seen = sum(p[2] for p in pieces), [], 0
    for _, high, rows in pieces[:-1]:
        seen += rows
        if seen * n >= total * (len(ends) + 1) and (not ends or ends[-1] < high):
            ends.append(high)
    return list(zip([None, *ends], [*ends, None]))


def _print(value: Callable[[str], Column], names: Iterable[str], schema: str) -> Column:
    """What a row holds, in short: the hash of its JSON text, which tells nulls apart, and that
    of its values, which tells times apart.  Null if it cannot be told."""
    if "map<" in schema:
        return F.lit(None).cast("struct<text:string,hash:bigint>")
    cols = [value(c) for c in sorted(names)]
    text = F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cols)]), {"ignoreNullFields": "false"})
    return F.struct(F.sha2(text, 256).alias("text"), F.xxhash64(*cols).alias("hash"))


class Table:
    """A keyed table below ``root``."""

    def __init__(self, spark: SparkSession, root: str, key: str = "id"):
        self.spark, self.root, self.key = spark, root, key

    # --- versions ---------------------------------------------------------

    def version(self) -> int:
        """The newest version, -1 if there is none."""
        known = M.versions(self.spark, self.root)
        return known[-1] if known else -1

    def manifest(self, version: int | None = None) -> dict | None:
        return M.load(self.spark, self.root, version)

    def _write(self, dealt: DataFrame, base: int, level: int) -> list[dict]:
        """Write rows that are dealt by key ranges, sorted by key; the entries of their files."""
        folder = M.data_folder(base)
        dealt.sortWithinPartitions(self.key).write.option("compression", "zstd").parquet(f"{self.root}/{folder}")
        found = self.spark.read.parquet(f"{self.root}/{folder}").groupBy(F.col("_metadata.file_name").alias("f")).agg(
            F.count(F.lit(1)).alias("n"), F.min(self.key).alias("low"), F.max(self.key).alias("high")).collect()  # a row per file
        return [{"path": f"{folder}/{r.f}", "rows": r.n, "low": r.low, "high": r.high, "level": level} for r in found]

    def _commit(self, base: int, files: list[dict], schema: str, op: str, **more) -> int:
        done = M.commit(self.spark, self.root, {"op": op, "key": self.key, "schema": schema, "files": files, **more}, base + 1)
        M.expire(self.spark, self.root, KEEP)
        return done

    # --- reading ----------------------------------------------------------

    def _rows(self, m: dict, files: list[dict]) -> DataFrame:
        reader = self.spark.read.schema(m["schema"])
        return reader.parquet(*[f"{self.root}/{f['path']}" for f in files]) if files else self.spark.createDataFrame([], m["schema"])

    def _newest(self, m: dict, files: list[dict], keys: DataFrame | None = None, dealt: tuple | None = None,
                shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
        """One row per key of ``files``: that of the highest level.  ``dealt``: the rows of
        this cut by key ranges, which the grouping then keeps, so rows are shuffled once."""
        parts = []
        for level in sorted({f["level"] for f in files}):
            parts.append(shape(self._rows(m, [f for f in files if f["level"] == level])).withColumn("_level", F.lit(level)))
        if not parts:
            return shape(self._rows(m, []))
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        if keys is not None:
            rows = rows.join(keys, self.key, "left_semi")
        if dealt:
            rows = self._between(rows, dealt).repartitionByRange(self.key)
        if len(parts) == 1:  # within a level every key stands once
            return rows.drop("_level")
        cols = [c for c in rows.columns if c != "_level"]
        return rows.groupBy(self.key).agg(F.max_by(F.struct(*cols), "_level").alias("_row")).select(
            *[F.col(c if c == self.key else f"_row.{c}").alias(c) for c in cols])

    def read(self, version: int | None = None) -> DataFrame | None:
        """All rows of a version (the newest by default)."""
        m = self.manifest(version)
        if m is None:
            return None
        if "key" not in m:  # written as a whole by ``sinks.write_table``
            return self.spark.read.parquet(f"{self.root}/{m['files'][0]['path']}")
        base, upserts = ([f for f in m["files"] if (f["level"] > 0) == x] for x in (False, True))
        if not upserts:
            return self._rows(m, base)
        ranges = _ranges(upserts)
        clear = [f for f in base if not _meets(f, ranges)]
        met = [f for f in base if _meets(f, ranges)]
        out = self._newest(m, upserts)
        if met:
            out = out.unionByName(self._rows(m, met).join(self._rows(m, upserts).select(self.key), self.key, "left_anti"))
        return out.unionByName(self._rows(m, clear)) if clear else out

    def lookup(self, keys: DataFrame, ranges: Ranges, version: int | None = None,
               shape: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame | None, list[str]]:
        """(rows of ``keys``, which lie in ``ranges``; the files read for them).  ``shape`` makes
        of rows, key included, what is shuffled."""
        m = self.manifest(version)
        if m is None:
            return None, []
        files = [f for f in m["files"] if _meets(f, ranges)]
        return self._newest(m, files, keys.select(self.key), shape=shape or (lambda df: df)), [f["path"] for f in files]

    # --- writing ----------------------------------------------------------

    def refresh(self, df: DataFrame, dealt: bool = False) -> int:
        """Replace all rows; keys must be unique.  ``dealt``: the rows are dealt over tasks
        by ranges of the key, or of what grows with it, and are not shuffled again."""
        for _ in range(RETRIES):
            base = self.version()
            try:
                return self._commit(base, self._write(df if dealt else df.repartitionByRange(self.key), base, 0), _ddl(df), "refresh")
            except M.Conflict:
                continue
        raise M.Conflict(f"{self.root}: {RETRIES} tries to commit")

    def _between(self, df: DataFrame, cut: tuple) -> DataFrame:
        """Rows whose key lies after the first and up to the second of ``cut``."""
        low, high = cut
        df = df if low is None else df.filter(F.col(self.key) > F.lit(low))
        return df if high is None else df.filter(F.col(self.key) <= F.lit(high))

    def upsert(self, batch: DataFrame, seq_col: str = "_seq", keep_first: Sequence[str] = (), stored: bool = False) -> int:
        """Rows of the batch replace those of their key; of several the one with the
        highest ``seq_col`` wins.  ``keep_first`` columns keep their oldest value.  A ``stored``
        batch (rows of files) is dealt slice by slice, so that not all of it lies in
        shuffle files at once."""
        cols = [c for c in batch.columns if c != seq_col]
        key = F.when(F.col(self.key).isNull(), F.raise_error(F.lit(f"null {self.key}"))).otherwise(F.col(self.key))
        batch = batch.withColumn(self.key, key)
        n = min(MAX_SLICES, -(-source_bytes(batch) // SLICE_BYTES)) if stored else 1
        keys = batch.groupBy(self.key).agg(F.count(F.lit(1)).alias("_n"))
        keys = materialize(keys.repartitionByRange(4 * n, self.key) if n > 1 else keys.repartitionByRange(self.key))
        pieces = keys.groupBy("_metadata.file_name").agg(
            F.min(self.key), F.max(self.key), F.max("_n"), F.sum("_n")).collect()  # a row per file
        cuts = _slices([(r[1], r[2], r[4]) for r in pieces], n)
        ranges = _joined([(r[1], r[2]) for r in pieces])
        rows = batch.select(F.col(self.key), F.struct(*cols).alias("_row"), F.struct(*keep_first, F.lit(0)).alias("_first"),
                            F.col(seq_col).alias("_seq"))
        if any(r[3] > ROWS_PER_SALT for r in pieces):  # a key with many rows is folded before its rows meet in a task
            rows = rows.groupBy(self.key).agg(F.max_by("_row", "_seq").alias("_row"), F.min_by("_first", "_seq").alias("_first"),
                                              F.max("_seq").alias("_seq"))
        try:
            return self._upsert(rows, keys, ranges, cuts, cols, keep_first, _ddl(batch.select(*cols)))
        finally:
            dematerialize(keys)

    def _folded(self, rows: DataFrame, keys: DataFrame, ranges: Ranges, base: int, m: dict | None, cols: list[str],
                keep_first: Sequence[str]) -> tuple[DataFrame, list[str]]:
        """(``rows`` folded and dealt by key ranges, with the stored values of ``keep_first``;
        the files read for them)."""
        met, looked, first = rows, [], F.col("_first")
        aggs = [F.max_by("_row", "_seq").alias("_row"), F.min_by("_first", "_seq").alias("_first")]
        if m is not None and keep_first:
            told = [c for c in cols if c not in (self.key, *keep_first)]
            old, looked = self.lookup(keys, ranges, base, lambda df: df.select(self.key, F.struct(
                *keep_first, F.lit(0), _print(F.col, set(df.columns) - {self.key, *keep_first}, m["schema"]).alias("_print")).alias("_old")))
            met = rows.unionByName(old, allowMissingColumns=True)
            aggs.append(F.collect_list("_old").alias("_olds"))
        folded = met.repartitionByRange(self.key).groupBy(self.key).agg(*aggs)
        if looked:
            now = _print(lambda c: F.col(f"_row.{c}"), told, m["schema"])
            folded = folded.withColumn("_now", now).filter(  # a row that says what is stored is not written again
                (F.size("_olds") == 0) | F.exists("_olds", lambda x: (x["_print"] != F.col("_now")) | x["_print"].isNull()))
            folded = folded.withColumn("_old", F.explode_outer("_olds"))
            first = F.col("_old")
        value = lambda c: F.coalesce(first[c], F.col("_first")[c]) if c in keep_first else F.col(f"_row.{c}")
        return folded.select(*[F.col(c) if c == self.key else value(c).alias(c) for c in cols]), looked

    def _upsert(self, rows: DataFrame, keys: DataFrame, ranges: Ranges, cuts: list[tuple], cols: list[str],
                keep_first: Sequence[str], ddl: str) -> int:
        """Fold and commit ``rows`` (key, _row, _first, _seq), one of ``cuts`` at a time: dealt by
        key ranges once, with the stored values of ``keep_first``, so that the wide rows are
        neither joined nor stored on their way to the table's files."""
        for _ in range(RETRIES):
            base = self.version()
            m = self.manifest(base) if base >= 0 else None
            if m is not None and "key" not in m:  # written as a whole: give its files key ranges first
                self.refresh(self.read(base))
                continue
            if not ranges and m is not None:
                return base
            level = base + 1 if m is not None else 0
            files, looked = [], []
            for cut in cuts if ranges else []:
                inside = [(max(low, cut[0]) if cut[0] is not None else low, min(high, cut[1]) if cut[1] is not None else high)
                          for low, high in ranges]
                inside = [(low, high) for low, high in inside if low <= high]
                new, read = self._folded(self._between(rows, cut), self._between(keys, cut), inside, base, m, cols, keep_first)
                with shuffles_removed(self.spark):
                    files += self._write(new, base, level)
                looked += [f for f in read if f not in looked]
            try:
                done = self._commit(base, (m["files"] if m else []) + files, ddl, "upsert", added=files, looked_up=looked)
            except M.Conflict:
                continue
            if len({f["level"] for f in (m["files"] if m else []) + files}) > MAX_LEVELS:
                self.compact()
            return done
        raise M.Conflict(f"{self.root}: {RETRIES} tries to commit")

    def compact(self) -> int:
        """Merge upserts into the base files they meet.  If another writer is
        faster nothing is done: the next upsert tries again."""
        base = self.version()
        m = self.manifest(base) if base >= 0 else None
        upserts = [f for f in m["files"] if f["level"] > 0] if m else []
        if not upserts:
            return base
        ranges = _ranges(upserts)
        stay = [f for f in m["files"] if f["level"] == 0 and not _meets(f, ranges)]
        go = [f for f in m["files"] if f["level"] > 0 or _meets(f, ranges)]
        n = min(MAX_SLICES, -(-source_bytes(self._rows(m, go)) // SLICE_BYTES))
        files = []
        for cut in _slices([(f["low"], f["high"], f["rows"]) for f in go], n):
            near = [f for f in go if (cut[0] is None or f["high"] > cut[0]) and (cut[1] is None or f["low"] <= cut[1])]
            with shuffles_removed(self.spark):
                files += self._write(self._newest(m, near, dealt=cut), base, 0)
        try:
            return self._commit(base, stay + files, m["schema"], "compact")
        except M.Conflict:
            return self.version()

    # --- changes ----------------------------------------------------------

    def unchanged(self, since: int, upto: int) -> bool:
        """Whether it is known that no row differs between two versions."""
        logs = [self.manifest(v) for v in range(since + 1, upto + 1)]
        return self.manifest(since) is not None and all(x is not None and x["op"] != "refresh" and not x.get("added") for x in logs)

    def changes(self, since: int, upto: int) -> DataFrame | None:
        """(key, old, new) of every key upserted after version ``since`` up to
        ``upto``; ``old`` is null for a new key.  None if the feed does not reach
        back so far or the table was replaced in between."""
        logs = [self.manifest(v) for v in range(since + 1, upto + 1)]
        if self.manifest(since) is None or any(x is None or x["op"] == "refresh" for x in logs):
            return None
        added = [f for x in logs for f in x.get("added", [])]
        m = self.manifest(upto)
        ranges = _ranges(added)
        keys = self._rows(m, added).select(self.key).distinct()
        new, _ = self.lookup(keys, ranges, upto)
        old, _ = self.lookup(keys, ranges, since)
        pack = lambda df, name: df.select(F.col(self.key).alias("key"), F.struct("*").alias(name))
        return pack(new, "new").join(pack(old, "old"), "key", "left")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
