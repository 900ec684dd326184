"""WARC archives: a writer with revisit records and a splittable reader.

Writing: records of equal payloads are found by digest; the one with the
largest id is a ``response`` with the payload, others are ``revisit`` records
that refer to it.  Every record is a gzip member of its own.  Each task attempt
writes a file under a name of its own and reports it; only files reported by
tasks that succeeded are listed, so retries and lost executors leave no record
twice.

Reading: files are cut into byte ranges; a task scans its range for the gzip
magic, checks each candidate by decoding the first bytes as a WARC header, and
reads every record that starts inside its range, beyond the range's end where
the record does.  No file is read whole by a task.

Paths go through ``pyarrow.fs``, so the folder may be in any store that it
knows; the folder must be one that all executors share.

Defined results: a null payload is empty; an empty payload is a payload like
any other; repeated ids with one payload that is the largest are all responses;
a null id sorts below all others and is read back as null; control characters
in a URL are percent-encoded; a null URL is read back as null; an empty table
gives no files and no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm import common as C
from hirelake.session import scratch_path

SPLIT_BYTES = 8 << 20
MAGIC = b"\x1f\x8b\x08"
ID = "urn:record:"
RECORD = T.StructType([
    T.StructField("page_id", T.LongType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("target_uri", T.StringType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload", T.BinaryType()), T.StructField("file", T.StringType()),
    T.StructField("offset", T.LongType())])


def _b32(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri if re.match(r"[a-z0-9+.-]+:", uri) else f"file://{uri}")


def _record(page: int | None, kind: str, refers: int | None, url: str | None, digest: str, size: int,
            payload: bytes) -> bytes:
    """One WARC record as one gzip member."""
    name = lambda i: f"<{ID}{'null' if i is None else i}>"
    safe = None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page)}", "WARC-Date: 1970-01-01T00:00:00Z",
            f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if safe is not None:
        head.append(f"WARC-Target-URI: {safe}")
    if kind == "revisit":
        head += [f"WARC-Refers-To: {name(refers)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: text/html", f"Content-Length: {len(payload)}"]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    text = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n"
    return pack.compress(text + payload + b"\r\n\r\n") + pack.flush()


def write(pages: DataFrame, folder: str, least: int = 0, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html") -> DataFrame:
    """Write a record per row below ``folder``; (file, bytes) of the archives.

    Payloads of fewer than ``least`` bytes are never revisits.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        C.text_or_empty(payload_col).cast("binary").alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("sha", F.sha1("payload"))
    # narrow: which record holds each payload that occurs more than once
    first = rows.filter(F.col("size") >= least).groupBy("sha", "size").agg(
        F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    first = C.stored(first.filter("n > 1"), "payloads")
    marked = C.join_unique(rows, first, ["sha", "size"], "n", rows.count(), how="left").select(
        "page_id", "url", F.when(F.col("first").isNull() | F.col("page_id").eqNullSafe(F.col("first")),
                                 F.col("payload")).alias("payload"), "size", "sha", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, fs, done = None, None, None, 0
        for batch in batches:
            for page, url, payload, size, sha, ref in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    fs, base = _store(folder)
                    fs.create_dir(base, recursive=True)
                    path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    out = fs.open_output_stream(path, compression=None)
                kind = "revisit" if payload is None else "response"
                member = _record(page, kind, ref, url, _b32(sha), size, payload or b"")
                out.write(member)
                done += len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [path.rsplit("/", 1)[1]], "bytes": [done]})

    return C.stored(marked.mapInArrow(run, "file string, bytes long"), "archives")


def _parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, body = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    return fields, body[: int(fields.get("Content-Length", "0"))]


def _number(name: str | None) -> int | None:
    m = re.fullmatch(rf"<{ID}(-?\d+)>", name or "")
    return int(m[1]) if m else None


class _Window:
    """Bytes of a file around a place, read a chunk at a time."""

    def __init__(self, handle, size: int, chunk: int = 1 << 20):
        self.handle, self.size, self.chunk = handle, size, chunk
        self.start, self.data = 0, b""

    def at(self, pos: int, least: int) -> bytes:
        """At least ``least`` bytes from ``pos`` on, fewer at the file's end."""
        if pos < self.start or pos + least > self.start + len(self.data):
            self.handle.seek(pos)
            self.start, self.data = pos, self.handle.read(max(self.chunk, least))
        return memoryview(self.data)[pos - self.start:]


def _member(win: _Window, pos: int) -> tuple[bytes, int] | None:
    """(content, end) of the WARC member at ``pos``; None if there is none."""
    z, out, at = zlib.decompressobj(31), [], pos
    held = b""
    while not z.eof and at < win.size:
        part = bytes(win.at(at, 1)[: 1 << 16])
        try:
            got = z.decompress(part)
        except zlib.error:
            return None
        at += len(part) - len(z.unused_data)
        out.append(got)
        if held is not None:
            held += got
            if len(held) >= 5:  # a candidate that is no WARC header is no member
                if not held.startswith(b"WARC/"):
                    return None
                held = None
    return (b"".join(out), at) if z.eof and held is None else None


def _scan(win: _Window, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Records that start in [start, end)."""
    pos = start
    while pos < end:
        view = bytes(win.at(pos, len(MAGIC))[: end - pos + len(MAGIC) - 1])
        hit = view.find(MAGIC)
        if hit < 0:
            pos += max(1, len(view) - len(MAGIC) + 1)
            continue
        pos += hit
        got = _member(win, pos) if pos < end else None
        if got is None:
            pos += 1
            continue
        yield pos, *_parse(got[0])
        pos = got[1]


def read(spark: SparkSession, folder: str, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records (RECORD) of ``files`` (file, bytes) below ``folder``."""
    ranges = files.select("file", "bytes", F.explode(
        F.expr(f"sequence(0L, greatest(bytes - 1, 0L), {split_bytes}L)")).alias("start"))
    ranges = ranges.repartition(max(spark.sparkContext.defaultParallelism, files.agg(
        F.coalesce(F.sum(F.ceil(F.col("bytes") / split_bytes)), F.lit(1))).first()[0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = RECORD.fieldNames()
        for batch in batches:
            for name, size, start in zip(*(c.to_pylist() for c in batch.columns)):
                fs, base = _store(folder)
                rows, held = [], 0
                with fs.open_input_file(f"{base}/{name}") as handle:
                    for at, h, body in _scan(_Window(handle, size), start, min(size, start + split_bytes)):
                        kind = h.get("WARC-Type")
                        digest = h.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                        if kind == "response":  # both are taken from the payload that was read
                            digest, size_of = _b32(hashlib.sha1(body).hexdigest()), len(body)
                        else:
                            size_of = int(h.get("X-Payload-Length", "0"))
                        rows.append((_number(h.get("WARC-Record-ID")), kind, _number(h.get("WARC-Refers-To")),
                                     h.get("WARC-Target-URI"), digest, size_of, body, name, at))
                        held += len(body)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], _ARROW)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], _ARROW)

    return ranges.mapInArrow(run, RECORD)


_ARROW = pa.schema([
    ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string()),
    ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("file", pa.string()),
    ("offset", pa.int64())])


def round_trip(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` to a new folder and read the archives back."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    return read(spark, folder, write(pages, folder, least))


def oracle_sql() -> str:
    """DuckDB SQL of ``round_trip`` over ``pages`` (unique ids)."""
    digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    part = f"list_transform(range(8), lambda j: substr('{digits}', CAST((x >> (35 - 5 * j)) & 31 AS INTEGER) + 1, 1))"
    return f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
h AS (SELECT *, sha1(t) AS hex, max(page_id) OVER (PARTITION BY t) AS last FROM p)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes,
       array_to_string(flatten(list_transform(list_transform([1, 11, 21, 31], lambda i: ('0x' || substr(hex, i, 10))::BIGINT),
                       lambda x: {part})), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM h"""
