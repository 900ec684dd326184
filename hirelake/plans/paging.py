"""Deep pages of a sorted table (FLT5): page n reads the files that hold it.

Rows are written in their order, dealt by range, at most ``FILE_ROWS`` to a file; the
manifest lists the files in order with their row counts and their last keys.  An
offset is found by adding up counts, a key by comparing last keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.operators.strategy import dematerialize, materialize
from hirelake.plans import manifest as M

FILE_ROWS = 100_000


class Pages:
    """Pages of a table below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def build(self, df: DataFrame, order: list[tuple[str, bool]], file_rows: int | None = None) -> None:
        """Write ``df`` in ``order``: columns, each with whether it falls; together they
        should be unique, so that pages are well defined.  Nulls come last.

        The rows are stored first: dealing them by range reads them twice, once for
        a sample of their order."""
        rows = materialize(df)
        by = _order(order)
        known = M.versions(self.spark, self.root)
        base = known[-1] if known else -1
        folder = M.data_folder(base)
        rows.repartitionByRange(*by).sortWithinPartitions(*by).write.option(
            "maxRecordsPerFile", file_rows or FILE_ROWS).parquet(f"{self.root}/{folder}")
        written = self.spark.read.schema(df.schema).parquet(f"{self.root}/{folder}")
        counts = written.groupBy(F.col("_metadata.file_name").alias("f")).agg(F.count(F.lit(1)).alias("n")).collect()  # a row per file
        files = [{"path": f"{folder}/{r.f}", "rows": r.n} for r in sorted(counts, key=lambda r: r.f)]
        M.commit(self.spark, self.root, {"op": "pages", "order": order, "schema": df.schema.json(), "files": files}, base + 1)
        M.expire(self.spark, self.root, 2)
        dematerialize(rows)

    def files(self, first: int, size: int) -> tuple[list[dict], int]:
        """The files that hold rows ``first`` to ``first + size - 1``, and the number of
        rows in the files before them."""
        before, out, skipped = 0, [], 0
        for f in M.load(self.spark, self.root)["files"]:
            if before + f["rows"] <= first:
                skipped = before + f["rows"]
            elif before < first + size:
                out.append(f)
            before += f["rows"]
        return out, skipped

    def page(self, number: int, size: int) -> DataFrame:
        """Page ``number`` (from 1) of ``size`` rows."""
        if number < 1 or size < 1:
            raise ValueError(f"page {number} of {size} rows")
        m = M.load(self.spark, self.root)
        first = (number - 1) * size
        files, skipped = self.files(first, size)
        schema = _schema(m["schema"])
        if not files:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(*[f"{self.root}/{f['path']}" for f in files])
        return rows.orderBy(*_order(m["order"])).offset(first - skipped).limit(size)


def _order(order: list) -> list[Column]:
    return [F.desc_nulls_last(c) if falls else F.asc_nulls_last(c) for c, falls in order]


def _schema(text: str):
    import json

    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads(text))
