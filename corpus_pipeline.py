"""Documents to tokens: the stages of a training-data pipeline, each written as Parquet and read again by the next.

1. quality: documents that the classifier rejects go (trained on the labels of the folder, see ``labelled``);
2. near_duplicates: of each class of documents linked by a Jaccard similarity of 0.8 or more, one stays: the one with the
   least id. Rows that repeat a document under one id become one. Rows with a null id link with nothing and stay;
3. decontamination: documents with words in a window of a benchmark item go;
4. pii: spans of personal data are replaced by their kind in brackets, and ``n_chars`` follows the text;
5. tokens: ids of every document and whether decoding gives its text again.

All stages but the last return the columns of their input, in order, and only ``doc_id`` and ``text`` are read by the operators:
other columns travel in one struct and cannot clash with theirs. Null and empty texts pass every stage that their score
lets pass; empty tables give empty results. The stages set the session's Arrow batches to 4 MB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.llm import bpe, decontamination, ngram_join, pii, quality
from passagework.session import scratch_dir, write_once

LEAST_QUALITY = 0.3
BROADCAST_IDS = 500_000
#: Bytes of rows after which a batch goes to Python. Spark's own bound, 64 MB, is held several times by an executor.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def _small_batches(spark: SparkSession) -> None:
    """Texts go to Python in small batches from here on; the setting stays, as a stage's result is evaluated after its return."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)


def _packed(docs: DataFrame) -> DataFrame:
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[docs[f"`{c}`"] for c in others]).alias("_others"))


def _unpacked(df: DataFrame, docs: DataFrame, text=None) -> DataFrame:
    def column(name: str):
        if name == "text" and text is not None:
            return text.alias("text")
        return F.col(name) if name in ("doc_id", "text") else F.col("_others")[name].alias(name)

    return df.select(*[column(c) for c in docs.columns])


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    stats = write_once(quality.document_stats(docs.select("doc_id", "text")).drop("text"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.fit(quality.labelled(stats, labels))
    scored = quality.score_documents(_packed(docs), model)
    return _unpacked(scored.filter(F.col("score") >= LEAST_QUALITY), docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    found = ngram_join.similar_documents(docs.select("doc_id", "text"))
    kept = write_once(found.filter("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("_rows")))
    kept = F.broadcast(kept) if kept.count() <= BROADCAST_IDS else kept
    mine = _packed(docs).join(kept, "doc_id")
    once = mine.filter("_rows = 1").unionByName(mine.filter("_rows > 1").dropDuplicates(["doc_id", "text"])).drop("_rows")
    return _unpacked(once.unionByName(_packed(docs).filter("doc_id IS NULL")), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontamination.find_contamination(_packed(docs), benchmark)
    return _unpacked(found.filter("n_hit = 0"), docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pii.fit(docs.select("text"))
    found = pii.find_pii(_packed(docs), model)
    found = found.withColumn("_redacted", pii.redact(F.col("text"), F.col("spans")))
    out = _unpacked(found, docs, F.col("_redacted"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    _small_batches(spark)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    decoded = bpe.encode_and_decode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        (F.col("bytes") == F.coalesce("text", F.lit("")).cast("binary")).alias("exact"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("tokens", token_stage),
]

#: Boosted trees, kernel features and byte pairs have no SQL; tested stage by stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of the documents that all stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark)
    for name, stage in STAGES[:-1]:
        docs = write_once(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
