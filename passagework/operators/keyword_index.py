"""Keyword search over an index that is built once: texts are read and cleaned at build only.

The build writes three tables: the distinct tokens of every text with the columns that hits show, the number of texts of every token, and
the postings: per token, blocks of at most about ``BLOCK_IDS`` keys of texts of similar size. A text with n distinct tokens shares at most
n with any query, so the greatest n of a block bounds the score of all its texts.

A search finds the exact k best by the number of shared tokens, ties by lower key, in two steps:

1. the rarest tokens of a query, up to ``FIRST_IDS`` postings, propose texts; the k-th best of their exact scores is a score that the
   k-th hit reaches, too;
2. a text that shares ``s`` of the ``T`` tokens of a query shares at least ``j`` of its ``T - s + j`` rarest ones. So only those lists are read,
   without the blocks whose bound is below ``s``; texts found ``j`` times are scored by their own tokens.

Lists of the most common tokens, which hold most of the postings, are thus read only for queries that nothing matches well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from passagework.functions.text import clean_text, words
from passagework.operators.search import _key
from passagework.session import is_small, write_once

BLOCK_IDS = 4096
FIRST_IDS = 20_000
#: The share of the least score that a candidate must reach among the rarest tokens.
SHARE = 0.25


def _tokens(text: Column) -> Column:
    return F.array_distinct(words(F.lower(clean_text(F.coalesce(text, F.lit(""))))))


def _sent(df: DataFrame) -> DataFrame:
    """The table, broadcast if it is small. It is a written one, so that the check costs little."""
    return F.broadcast(df) if is_small(df) else df


def build_keyword_index(
    index: DataFrame, path: str, id_col: str = "id", text_col: str = "content", columns: tuple[str, ...] = (),
    block_ids: int = BLOCK_IDS,
) -> None:
    """Write the index of a table with unique keys; hits can show ``columns``. A null text has no tokens."""
    rows = index.select(_key(index, id_col).alias("id"), _tokens(F.col(text_col)).alias("tokens"), *[
        F.col(c).alias(c) for c in columns if c != id_col])
    rows = rows.withColumn("n", F.size("tokens"))
    rows.write.mode("overwrite").parquet(f"{path}/texts")
    texts = index.sparkSession.read.schema(rows.schema).parquet(f"{path}/texts")
    entries = texts.select(F.explode("tokens").alias("token"), "id", "n").withColumn("size", F.floor(2 * F.log2("n")).cast("int"))
    # a token that many texts of one size share is cut by a hash of their keys; few tokens are
    hot = entries.groupBy("token", "size").agg(F.count("*").alias("k")).filter(F.col("k") > block_ids)
    hot = write_once(hot.select("token", "size", F.ceil(F.col("k") / block_ids).cast("int").alias("parts")))
    cut = entries.join(_sent(hot), ["token", "size"], "left").withColumn(
        "part", F.coalesce(F.pmod(F.xxhash64("id"), F.col("parts")), F.lit(0)))
    postings = cut.groupBy("token", "size", "part").agg(
        F.max("n").alias("most"), F.array_sort(F.collect_list("id")).alias("ids"))
    postings.select("token", "most", "ids").write.mode("overwrite").parquet(f"{path}/postings")
    written = index.sparkSession.read.parquet(f"{path}/postings")
    lists = written.groupBy("token").agg(F.sum(F.size("ids")).alias("texts"))
    lists.write.mode("overwrite").parquet(f"{path}/tokens")


def _found(asked: DataFrame, postings: DataFrame) -> DataFrame:
    """``query_id, id, shared``: the texts in the lists of ``asked`` (``query_id, token, bound``), without blocks below the bound."""
    read = postings.join(_sent(asked), "token").filter(F.col("most") >= F.col("bound"))
    return read.select("query_id", F.explode("ids").alias("id")).groupBy("query_id", "id").agg(F.count("*").alias("shared"))


def _scored(pairs: DataFrame, texts: DataFrame, asked: DataFrame) -> DataFrame:
    """The pairs with the number of shared tokens and the columns of the text."""
    both = texts.join(_sent(write_once(pairs.select("query_id", "id"))), "id").join(_sent(asked), "query_id")
    return both.withColumn("score", F.size(F.array_intersect("tokens", "asked")).cast("double")).drop("tokens", "asked", "n")


def indexed_search(
    spark: SparkSession, path: str, queries: DataFrame, k: int, query_id_col: str = "query_id",
    query_text_col: str = "query_text", first_ids: int = FIRST_IDS,
) -> DataFrame:
    """``query_id, rank, id``, the columns of the index and ``score`` of the k texts that share most tokens with each query.

    Texts that share none are no hits, and neither has a query without known tokens.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    ranked, asked, texts = _asked(spark, path, queries, query_id_col, query_text_col)
    candidates = _candidates(spark, path, ranked, asked, texts, k, first_ids)
    found = _scored(candidates, texts, asked).join(candidates.select("query_id", "least").distinct(), "query_id")
    found = found.filter((F.col("score") >= F.col("least")) & (F.col("score") > 0)).drop("least")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    extra = [c for c in texts.columns if c not in ("id", "tokens", "n")]
    return found.select("query_id", "rank", "id", *extra, "score")


def _asked(spark: SparkSession, path: str, queries: DataFrame, id_col: str, text_col: str):
    """Tokens of the queries by rarity, per query and in one array, and the texts of the index."""
    texts, known = spark.read.parquet(f"{path}/texts"), spark.read.parquet(f"{path}/tokens")
    rows = queries.select(_key(queries, id_col).alias("query_id"), F.explode(_tokens(F.col(text_col))).alias("token")).distinct()
    rows = write_once(known.join(_sent(write_once(rows)), "token"))
    rarest = Window.partitionBy("query_id").orderBy("texts", "token")
    ranked = rows.select(
        "query_id", "token", "texts", F.row_number().over(rarest).alias("place"),
        F.sum("texts").over(rarest.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"),
        F.count("*").over(Window.partitionBy("query_id")).alias("n_tokens"))
    asked = rows.groupBy("query_id").agg(F.collect_list("token").alias("asked"))
    return write_once(ranked), write_once(asked), texts


def _candidates(
    spark: SparkSession, path: str, ranked: DataFrame, asked: DataFrame, texts: DataFrame, k: int, first_ids: int
) -> DataFrame:
    """``query_id, id, least``: texts that may be among the k best, and the score that the k-th best has at least."""
    postings = spark.read.parquet(f"{path}/postings")
    rare = ranked.filter((F.col("so_far") <= first_ids) | (F.col("place") == 1))
    first = _found(write_once(rare.select("query_id", "token", F.lit(0).alias("bound"))), postings)
    likely = Window.partitionBy("query_id").orderBy(F.desc("shared"), F.asc("id"))
    first = first.withColumn("place", F.row_number().over(likely)).filter(F.col("place") <= 4 * k)
    exact = _scored(first, texts, asked).select("query_id", "score")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"))
    kth = exact.withColumn("place", F.row_number().over(best)).filter(F.col("place") == k)
    kth = write_once(kth.select("query_id", F.col("score").cast("int").alias("least")))
    bounded = ranked.join(_sent(kth), "query_id", "left").withColumn("least", F.coalesce("least", F.lit(1)))
    bounded = bounded.withColumn("times", F.greatest(F.floor(F.col("least") * SHARE).cast("int"), F.lit(1)))
    read = bounded.filter(F.col("place") <= F.col("n_tokens") - F.col("least") + F.col("times"))
    read = write_once(read.select("query_id", "token", "texts", F.col("least").alias("bound"), "times"))
    needed = write_once(read.groupBy("query_id").agg(F.max("bound").alias("least"), F.max("times").alias("times")))
    found = _found(read.select("query_id", "token", "bound"), postings).join(_sent(needed), "query_id")
    return write_once(found.filter(F.col("shared") >= F.col("times")).select("query_id", "id", "least"))


def share_read(spark: SparkSession, path: str, queries: DataFrame, k: int, query_id_col: str = "query_id",
               query_text_col: str = "query_text", first_ids: int = FIRST_IDS) -> DataFrame:
    """``query_id, n_postings, n_candidates``: postings of all tokens of a query, and texts whose tokens a search compares."""
    ranked, asked, texts = _asked(spark, path, queries, query_id_col, query_text_col)
    candidates = _candidates(spark, path, ranked, asked, texts, k, first_ids)
    every = ranked.groupBy("query_id").agg(F.sum("texts").alias("n_postings"))
    return every.join(candidates.groupBy("query_id").agg(F.count("*").alias("n_candidates")), "query_id", "left").select(
        "query_id", "n_postings", F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"))
