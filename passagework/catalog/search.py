"""Vector index, similarity search and keyword search."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.catalog.common import (
    plain, spread_table, sql_chunks, sql_clean, sql_id, sql_nearest, sql_vectors, table,
)
from passagework.catalog.tables import _AFTER, _states
from passagework.functions.vectors import digit_embedding, load_digit_embedder
from passagework.operators.index import build_index, read_index, refresh_index
from passagework.operators.chunking import chunk_rows
from passagework.operators.keyword_index import build_keyword_index, indexed_search
from passagework.operators.search import (
    CentreTree, approximate_search, assign_lists, clustered_search, keyword_search, list_bounds, probe_lists, refine_centres,
    share_scored, similarity_search,
)
from passagework.plans.retrieval import embedded_chunks, expression_embedding, model_embedding, nearest_chunks
from passagework.session import scratch_dir

N_PROBE = 5


def _vectors(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The vector table as index and, row by row, as queries."""
    rows = table(spark, folder, "embeddings")
    return rows.withColumnRenamed("vec_id", "id"), rows.withColumnRenamed("vec_id", "query_id")


def _search(k: int = 3, **options):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        index, queries = _vectors(spark, folder)
        return plain(similarity_search(index, queries, k, **options))

    return run


def vector_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("url"),
        F.lit(None).cast("string").alias("content"), "embedding",
    )
    built = build_index(rows, f"{scratch_dir(spark)}/index", embedding_col="embedding")
    return built.select("id", "url", F.round("norm", 6).alias("norm"), F.size("embedding").cast("bigint").alias("n_dims"))


def _source(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").alias("id"), F.col("lang").alias("url"), F.col("text").alias("content"))


def refreshed_index(spark: SparkSession, folder: str) -> DataFrame:
    before, after = _states(spark, folder)
    path = f"{scratch_dir(spark)}/index"
    build_index(_source(before), path, load_embedder=load_digit_embedder)
    refresh_index(_source(after), path, load_embedder=load_digit_embedder)
    rows = read_index(spark, path)
    size = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v)
    return rows.select("id", F.md5("content").alias("content_md5"), size.cast("bigint").alias("n_tokens"))


def _label_means(index: DataFrame) -> dict:
    """The mean vector of each label, of which there are few."""
    parts = index.select("label", F.posexplode("embedding").alias("dim", "x"))
    means = parts.groupBy("label", "dim").agg(F.avg(F.col("x").cast("double")).alias("x"))
    centres = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("dim", "x"))).alias("c")).orderBy("label")
    return {row["label"]: np.array([x for _, x in row["c"]]) for row in centres.collect()}


def _lists(spark: SparkSession, folder: str) -> tuple[DataFrame, np.ndarray, DataFrame]:
    """Lists around the mean vector of each label."""
    index, queries = _vectors(spark, folder)
    table = np.array(list(_label_means(index).values()))
    return assign_lists(index, table), table, queries


def approximate(n_probe: int | None):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        listed, centres, queries = _lists(spark, folder)
        return plain(approximate_search(listed, centres, queries, 3, n_probe or len(centres)))

    return run


def approximate_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Share of the exact hits that the approximate search finds, and share of pairs it scores."""
    listed, centres, queries = _lists(spark, folder)
    exact = similarity_search(listed, queries, 3).select("query_id", "id")
    found = approximate_search(listed, centres, queries, 3, N_PROBE).select("query_id", "id", F.lit(1).alias("hit"))
    recall = exact.join(found, ["query_id", "id"], "left").agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
    scored = share_scored(listed, probe_lists(queries, centres, N_PROBE))
    return recall.select(F.round("recall", 9).alias("recall"), F.round(F.lit(scored), 9).alias("share_scored"))


N_SEEDS = 25


def _seeds(index: DataFrame) -> np.ndarray:
    """The vectors of the lowest keys, a bounded number of them, as first centres."""
    chosen = index.orderBy("id").limit(N_SEEDS).select("embedding").collect()
    return np.array([row["embedding"] for row in chosen], dtype=np.float64)


def trained_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Lists around centres that one step of k-means makes of some vectors, found through a tree of centres."""
    index, queries = _vectors(spark, folder)
    tree = CentreTree(refine_centres(index, _seeds(index)), beam=2)
    listed = assign_lists(index, tree)
    return plain(approximate_search(listed, tree, queries, 3, N_PROBE))


def clustered(spark: SparkSession, folder: str) -> DataFrame:
    """Exact search over an index whose lists are skipped where their angle rules out the k-th score."""
    index, queries = _vectors(spark, folder)
    centres = refine_centres(index, _seeds(index), 3)
    listed = assign_lists(index, centres)
    return plain(clustered_search(listed, centres, list_bounds(listed, centres), queries, 3)[0])


def skipped(spark: SparkSession, folder: str) -> DataFrame:
    """Whether exact search leaves lists unopened for a query, next to its hits, over vectors that lie close to the mean of their label."""
    index, _ = _vectors(spark, folder)
    centres = _label_means(index)
    means = spark.createDataFrame([(label, row.tolist()) for label, row in centres.items()], "label int, mean array<double>")
    moved = F.zip_with("embedding", "mean", lambda x, m: x.cast("double") + 20 * m)
    close = index.join(F.broadcast(means), "label").select("id", moved.alias("embedding"))
    listed = assign_lists(close, np.array(list(centres.values())))
    bounds = list_bounds(listed, np.array(list(centres.values())))
    queries = close.withColumnRenamed("id", "query_id")
    found, pairs = clustered_search(listed, np.array(list(centres.values())), bounds, queries, 3)
    opened = pairs.groupBy("query_id").agg(F.count("*").alias("opened"))
    hits = found.groupBy("query_id").agg(F.array_join(F.sort_array(F.collect_list("id")), ",").alias("hits"))
    return opened.join(hits, "query_id").select("query_id", (F.col("opened") < len(centres)).alias("some_skipped"), "hits")


def keyword(spark: SparkSession, folder: str) -> DataFrame:
    return plain(keyword_search(
        spread_table(spark, folder, "documents"), table(spark, folder, "benchmark"), 3, ["lang", "source"],
        id_col="doc_id", text_col="text", query_id_col="item_id", query_text_col="text",
    ))


def indexed_keyword(spark: SparkSession, folder: str) -> DataFrame:
    """The same over an index of postings that is built once."""
    path = f"{scratch_dir(spark)}/keywords"
    build_keyword_index(spread_table(spark, folder, "documents"), path, "doc_id", "text", ("lang", "source"))
    return plain(indexed_search(spark, path, table(spark, folder, "benchmark"), 3, "item_id", "text"))


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """For each benchmark passage, the three nearest chunks of the documents."""
    embedding = expression_embedding(digit_embedding)
    chunks = embedded_chunks(spread_table(spark, folder, "documents"), "text", "doc_id", embedding)
    found = nearest_chunks(
        chunks, table(spark, folder, "benchmark"), "item_id", "text", embedding, 3, ["doc_id", "chunk_pos", "content"]
    )
    return plain(found)


def text_index(spark: SparkSession, folder: str) -> DataFrame:
    """An index that computes its vectors from the text, searched with texts of the same model."""
    documents = spread_table(spark, folder, "documents").select(F.col("doc_id").alias("url"), "text")
    chunks = chunk_rows(documents, "text", "url").select("id", F.col("url").cast("string").alias("url"), "content")
    index = build_index(chunks, f"{scratch_dir(spark)}/index", load_embedder=load_digit_embedder)
    found = nearest_chunks(
        index, table(spark, folder, "benchmark"), "item_id", "text", model_embedding(load_digit_embedder), 3, ["url"]
    )
    return plain(found)


QUERIES = {
    "flagship_nearest_chunks": flagship,
    "v1_vector_index": vector_index,
    "v2_refreshed_index": refreshed_index,
    "v3_similarity_search": _search(),
    "v3_search_in_blocks": _search(block_bytes=64_000),
    "p5_search_columns": _search(columns=["label"]),
    "v4_filtered_search": _search(where="label = 3"),
    "v5_permission_search": _search(match=("label", "label")),
    "v6_approximate_search": approximate(N_PROBE),
    "v6_approximate_all_lists": approximate(None),
    "v6_approximate_quality": approximate_quality,
    "v6_trained_lists": trained_lists,
    "v3_clustered_search": clustered,
    "v3_skipped_lists": skipped,
    "v7_keyword_search": keyword,
    "v7_keyword_index": indexed_keyword,
    "v8_text_index": text_index,
}


def _sql_search(condition: str = "TRUE", extra: str = "") -> str:
    return f"""WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
      s AS (SELECT q.vec_id AS query_id, i.vec_id AS id, i.label::BIGINT AS label,
              round(list_cosine_similarity(q.v, i.v), 6) AS score FROM e q JOIN e i ON {condition})
      SELECT query_id, rank, id, {extra} score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s) WHERE rank <= 3"""


_LISTED = """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
      mean AS (SELECT label, dim, avg(x) AS x FROM (
        SELECT label, generate_subscripts(v, 1) AS dim, unnest(v) AS x FROM e) GROUP BY ALL),
      centre AS (SELECT label AS c, list(x ORDER BY dim) AS m FROM mean GROUP BY label),
      near AS (SELECT vec_id, c, row_number() OVER (
        PARTITION BY vec_id ORDER BY round(list_cosine_similarity(v, m), 6) DESC, c) AS n FROM e CROSS JOIN centre),
      listed AS (SELECT vec_id, c FROM near WHERE n = 1),
      probe AS (SELECT vec_id, c FROM near WHERE n <= PROBES),
      pair AS (SELECT p.vec_id AS query_id, l.vec_id AS id FROM probe p JOIN listed l USING (c)),
      scored AS (SELECT query_id, id, round(list_cosine_similarity(q.v, i.v), 6) AS score
        FROM pair JOIN e q ON q.vec_id = query_id JOIN e i ON i.vec_id = id),
      hits AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored) WHERE rank <= 3)""".replace("PROBES", str(N_PROBE))

_TRAINED = """WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
      u AS (SELECT vec_id, v, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS w FROM e),
      seed AS (SELECT (row_number() OVER (ORDER BY vec_id) - 1)::INT AS c, v AS m FROM (SELECT * FROM e ORDER BY vec_id LIMIT SEEDS)),
      near AS (SELECT vec_id, w, c, row_number() OVER (
        PARTITION BY vec_id ORDER BY round(list_cosine_similarity(v, m), 6) DESC, c) AS n FROM u CROSS JOIN seed),
      mean AS (SELECT c, dim, avg(x) AS x FROM (
        SELECT c, generate_subscripts(w, 1) AS dim, unnest(w) AS x FROM near WHERE n = 1) GROUP BY ALL),
      moved AS (SELECT c, list(x ORDER BY dim) AS m FROM mean GROUP BY c),
      centre AS (SELECT c, coalesce(moved.m, seed.m) AS m FROM seed LEFT JOIN moved USING (c)),
      size AS (SELECT count(*) AS n, floor(sqrt(count(*)))::INT AS k FROM centre),
      top AS (SELECT t, m FROM (SELECT unnest(range(k)) AS t, n, k FROM size) JOIN centre ON c = t * n // k),
      leaf AS (SELECT c, m, t FROM (SELECT centre.c, centre.m, t, row_number() OVER (
        PARTITION BY c ORDER BY round(list_cosine_similarity(centre.m, top.m), 6) DESC, t) AS n FROM centre CROSS JOIN top) WHERE n = 1),
      beam AS (SELECT vec_id, v, t FROM (SELECT vec_id, v, t, row_number() OVER (
        PARTITION BY vec_id ORDER BY round(list_cosine_similarity(v, m), 6) DESC, t) AS n FROM e CROSS JOIN top) WHERE n <= 2),
      ranked AS (SELECT vec_id, c, row_number() OVER (
        PARTITION BY vec_id ORDER BY round(list_cosine_similarity(v, m), 6) DESC, c) AS n FROM beam JOIN leaf USING (t)),
      pair AS (SELECT p.vec_id AS query_id, l.vec_id AS id FROM ranked p JOIN ranked l USING (c) WHERE p.n <= PROBES AND l.n = 1),
      scored AS (SELECT query_id, id, round(list_cosine_similarity(q.v, i.v), 6) AS score
        FROM pair JOIN e q ON q.vec_id = query_id JOIN e i ON i.vec_id = id)
      SELECT query_id, rank, id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored) WHERE rank <= 3
      """.replace("PROBES", str(N_PROBE)).replace("SEEDS", str(N_SEEDS))

_SKIPPED = """WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
      mean AS (SELECT label, dim, avg(x) AS x FROM (
        SELECT label, generate_subscripts(v, 1) AS dim, unnest(v) AS x FROM e) GROUP BY ALL),
      centre AS (SELECT label, list(x ORDER BY dim) AS m FROM mean GROUP BY label),
      close AS (SELECT vec_id, list_transform(list_zip(v, m), lambda z: z[1] + 20 * z[2]) AS v FROM e JOIN centre USING (label)),
      s AS (SELECT q.vec_id AS query_id, i.vec_id AS id, round(list_cosine_similarity(q.v, i.v), 6) AS score
        FROM close q CROSS JOIN close i),
      r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)
      SELECT query_id, true AS some_skipped, string_agg(id::VARCHAR, ',' ORDER BY id) AS hits FROM r WHERE rank <= 3 GROUP BY 1"""

_CHUNKS = sql_chunks("SELECT doc_id AS key, text FROM documents")
_KEYED = f"SELECT {sql_id('key', 'chunk_pos')} AS id, content AS text FROM chunks"
_NEAREST = f"""WITH RECURSIVE {_CHUNKS},
  {sql_vectors('idx', _KEYED)}, {sql_vectors('qry', 'SELECT item_id AS id, text FROM benchmark')},
  {sql_nearest('idx', 'qry')},
  keyed AS (SELECT {sql_id('key', 'chunk_pos')} AS id, key AS doc_id, chunk_pos, content FROM chunks)"""
_WORDS = "list_distinct(string_split(lower({0}), ' '))"
_KEYWORDS = f"""WITH
      d AS (SELECT doc_id, unnest({_WORDS.format(sql_clean('text'))}) AS w FROM documents),
      b AS (SELECT item_id, unnest({_WORDS.format(sql_clean('text'))}) AS w FROM benchmark),
      s AS (SELECT item_id AS query_id, doc_id AS id, count(*)::DOUBLE AS score FROM d JOIN b USING (w) WHERE w <> ''
            GROUP BY ALL),
      r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM s)
      SELECT query_id, rank, id, lang, source, score FROM r JOIN documents ON doc_id = id WHERE rank <= 3"""

ORACLES = {
    "flagship_nearest_chunks": f"""{_NEAREST}
      SELECT query_id, rank, id, doc_id, chunk_pos, content, score FROM hits JOIN keyed USING (id)""",
    "v1_vector_index": """SELECT vec_id AS id, label::VARCHAR AS url,
      round(sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])), 6) AS norm,
      len(embedding)::BIGINT AS n_dims FROM embeddings""",
    "v2_refreshed_index": f"""SELECT doc_id AS id, md5(text) AS content_md5,
      len(regexp_extract_all(text, '\\S+'))::BIGINT AS n_tokens FROM ({_AFTER})""",
    "v3_similarity_search": _sql_search(),
    "v3_search_in_blocks": _sql_search(),
    "p5_search_columns": _sql_search(extra="label,"),
    "v4_filtered_search": _sql_search("i.label = 3"),
    "v5_permission_search": _sql_search("i.label = q.label"),
    "v6_approximate_search": f"{_LISTED} SELECT query_id, rank, id, score FROM hits",
    "v6_approximate_quality": f"""{_LISTED},
      every AS (SELECT q.vec_id AS query_id, i.vec_id AS id, round(list_cosine_similarity(q.v, i.v), 6) AS score FROM e q, e i),
      exact AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM every) WHERE rank <= 3)
      SELECT round(avg(CASE WHEN h.id IS NULL THEN 0 ELSE 1 END), 9) AS recall,
        round((SELECT count(*) FROM probe JOIN listed USING (c)) / (SELECT count(*) * count(*) FROM e), 9) AS share_scored
      FROM exact x LEFT JOIN hits h ON h.query_id = x.query_id AND h.id = x.id""",
    "v6_approximate_all_lists": _sql_search(),
    "v6_trained_lists": _TRAINED,
    "v3_clustered_search": _sql_search(),
    "v3_skipped_lists": _SKIPPED,
    "v7_keyword_search": _KEYWORDS,
    "v7_keyword_index": _KEYWORDS,
    "v8_text_index": f"""{_NEAREST}
      SELECT query_id, rank, id, doc_id::VARCHAR AS url, score FROM hits JOIN keyed USING (id)""",
}
