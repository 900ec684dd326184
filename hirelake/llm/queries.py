"""Registered queries of the training-data operators: QUERIES and ORACLES."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import common as C
from hirelake.llm import (
    align, ann, decontaminate, jaccard_join, langid, lmscore, packing, phrases, secrets, sharding, simhash, toxicity, warc)
from hirelake.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


OP10 = jaccard_join.Rule(k=4, num=85, den=100)


@register("op10_jaccard_join", jaccard_join.oracle_sql(OP10))
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets reach Jaccard 0.85."""
    return jaccard_join.jaccard_by_row(C.table(spark, sf_dir, "documents"), OP10)


@register("op7_secret_scan", secrets.oracle_sql())
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, scanned once per distinct text."""
    found = secrets.scan(C.table(spark, sf_dir, "documents"), scratch_path(spark, "blob-ledger"))
    for k in secrets.KINDS:
        found = found.withColumn(f"n_{k.name}", F.expr(f"cast(size(filter(spans, s -> s.kind = '{k.name}')) as long)"))
    listed = secrets.listed(F.col("spans"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(listed, 256).alias("base_sha256"),
                        listed.alias("spans"))


@register("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 ids."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    parts = packing.pieces(C.table(spark, sf_dir, "documents"), tokenizer, capacity=4096, end_id=1)
    parts = C.stored(parts.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "pieces")
    return packing.packed(parts, ["doc_id", "piece"], capacity=4096)


@register("op3_sharding")
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 of near equal bytes, equal texts together."""
    out = sharding.sharded(C.table(spark, sf_dir, "documents"), shards=24, overhead=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "group_rows")


@register("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned where crc32(doc_id) mod 4 is not 2."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    docs = C.table(spark, sf_dir, "documents").withColumn("held_out", held)
    return langid.predict(docs, langid.fit(docs.filter(~F.col("held_out"))), ["doc_id", "held_out"])


@register("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of a benchmark item in a document, with its edits."""
    return decontaminate.matches(C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "benchmark"))


@register("op4_warc", warc.oracle_sql())
def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, written to archives and read back."""
    return warc.round_trip(C.table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op8_nearest_neighbours")
def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20."""
    return ann.nearest(C.table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0", k=20)


@register("op6_lm_score")
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every document; target: labelled good."""
    docs = C.table(spark, sf_dir, "documents")
    good = C.table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return lmscore.score(docs, lmscore.fit(docs, good))


@register("op9_toxicity")
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category probabilities of every document, and whether it is toxic."""
    docs, labels = C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels")
    names = ["low_quality", "toxic"]
    chain = toxicity.fit(docs, labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic"), names)
    out = toxicity.score(docs, chain, categories=names)
    cut = chain.thresholds[-1] if chain else 1.0
    return out.withColumn("toxic", F.coalesce(F.col("p_toxic") >= cut, F.lit(False)))


@register("op11_phrases", phrases.oracle_sql())
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of 2 to 4 words of each language."""
    return phrases.collocations(C.table(spark, sf_dir, "documents"))


@register("op12_simhash")
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose SimHash fingerprints differ in at most 3 bits."""
    return simhash.near_duplicates(C.table(spark, sf_dir, "documents"), k=3, radius=3)


@register("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of a byte-level and a sentence-piece tokenizer on every text."""
    return align.aligned(C.table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                         public_tokenizers.path("piece_bpe_32k.model"))
