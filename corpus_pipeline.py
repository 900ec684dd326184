"""Corpus pipeline: language ID, near-duplicate join, decontamination, secret
scan, packing.  Every stage reads what the one before it wrote.

All stages but the last return the columns of ``documents``; the last returns
the packed pieces with their token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import common as C
from hirelake.llm import decontaminate, jaccard_join, langid, packing, secrets
from hirelake.session import scratch_path

MIN_SCORE = 0.5  # a text whose best language is less likely than this goes


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a letter whose language is clear; learned from the labelled
    rows.  If no row has a label nothing is known and every row stays."""
    C.small_batches(spark)
    model = langid.fit(docs)
    if not model.langs:
        return docs
    names = [f"c{i}" for i in range(len(docs.columns))]  # no clash with the added columns
    marked = langid.predict(docs.toDF(*names), model, names, text_col=names[docs.columns.index("text")])
    kept = marked.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SCORE))
    return kept.select(*names).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of linked rows: the one with the smallest id, a row
    without an id only if none has one.  Rows are told apart by their place in the
    stored input, so repeated rows, null ids and an id on several texts are
    rows like all others."""
    C.small_batches(spark)
    names = [f"c{i}" for i in range(len(docs.columns))]  # no clash with the added columns
    keyed = C.keyed(docs, names)
    doc_id, text = names[docs.columns.index("doc_id")], names[docs.columns.index("text")]
    found = jaccard_join.jaccard_components(keyed, jaccard_join.Rule(k=5, num=80, den=100), "key", text)
    found = C.stored(found.join(keyed.select("key", doc_id), "key"), "row-components")
    first = found.groupBy("component_id").agg(F.min(F.struct(F.col(doc_id).isNull(), doc_id, "key")).alias("x"))
    gone = found.select("key").join(first.select("x.key"), "key", "left_anti")
    gone = C.broadcast_if_few(C.stored(gone, "near-duplicates"))
    return keyed.join(gone, "key", "left_anti").select(*names).toDF(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no passage of a benchmark item."""
    C.small_batches(spark)
    return decontaminate.clean(docs, C.table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, secrets masked; ``n_chars`` follows the text."""
    out = secrets.redacted(docs, scratch_path(spark, "blob-ledger"))
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 ids: doc_id, piece, start, length, ids, and
    the piece's sequence_id and offset.  The ids are written once; only the
    pieces' lengths and keys (their place in the files) go through the packing."""
    C.small_batches(spark)
    parts = C.stored(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")), "pieces")
    parts = parts.withColumns({"_file": F.xxhash64("_metadata.file_name"), "_row": F.col("_metadata.row_index")})
    narrow = C.stored(parts.select("_file", "_row", "length"), "lengths")
    places = C.stored(packing.packed(narrow, ["_file", "_row"]).drop("length"), "places")
    return parts.join(C.broadcast_if_few(places), ["_file", "_row"]).drop("_file", "_row")


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

#: Tokenization and the byte n-gram model have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again; what a
    stage has stored is removed once its result is written, and that result once
    the next one is."""
    docs, before = C.table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with C.consumed(spark) as keep:
            docs = keep(stage(spark, docs, sf_dir), name)
        for path in before:
            C.remove(spark, path)
        before = list(keep.paths)
    return STAGES[-1][1](spark, docs, sf_dir)
