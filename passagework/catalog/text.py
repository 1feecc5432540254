"""Extraction, cleaning, chunking and embedding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.catalog.common import (
    load_word_encoder, noise, plain, spread_table, sql_bucket, sql_chunks, sql_clean, sql_id, sql_noise, sql_tokens, sql_vectors, table,
)
from passagework.functions.text import (
    PAGE_BREAK, clean_pages, clean_text, collapse_whitespace, join_hyphenated, sentences, split_pages,
    tighten_punctuation, word_count,
)
from passagework.functions.vectors import digit_embedding, load_digit_embedder
from passagework.operators.chat import context_check
from passagework.operators.chunking import chunk_report, chunk_rows, encoder_splitter, token_windows
from passagework.operators.embedding import embed, embed_distinct, request_payloads
from passagework.operators.extract import chunk_files, extract, rejects
from passagework.session import scratch_dir, write_once
from passagework.streaming.embed_sync import read_sync_table, sync_embeddings


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread_table(spark, folder, "documents")


def _step(step):
    return lambda s, d: _documents(s, d).select("doc_id", step(noise("text")).alias("cleaned"))


def _paged(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with every line on a page of its own."""
    paged = F.replace(F.col("text"), F.lit("\n"), F.lit(PAGE_BREAK))
    return _documents(spark, folder).select("doc_id", paged.alias("text"))


def _broken_bytes(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as bytes; the French ones end in an invalid sequence."""
    bad = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FFFE00")))
    content = F.when(F.col("lang") == "fr", bad).otherwise(F.encode("text", "UTF-8"))
    return _documents(spark, folder).select("doc_id", content.alias("content"))


def failed_parse(spark: SparkSession, folder: str) -> DataFrame:
    raw = _broken_bytes(spark, folder)
    chunked = chunk_files(raw, "utf8", path_col="doc_id").select("doc_id").distinct()
    lost = rejects(extract(raw, "utf8"))
    return chunked.withColumn("outcome", F.lit("chunked")).unionByName(
        lost.select("doc_id", F.lit("rejected").alias("outcome"))
    )


def _chunks(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder).select("doc_id", "lang", "source", "text")
    return chunk_rows(documents, "text", "doc_id")


def _dimensions(df: DataFrame, key: str, embedding: str | F.Column = "embedding") -> DataFrame:
    """Non-zero dimensions of an embedding as rows."""
    found = df.select(key, F.posexplode(embedding).alias("dim", "v")).filter(F.col("v") > 0)
    return found.select(key, F.lower(F.hex("dim")).alias("dim"), F.col("v").cast("double").alias("v"))


def embed_udf(spark: SparkSession, folder: str) -> DataFrame:
    documents = _documents(spark, folder).select("doc_id", "text")
    return _dimensions(embed(documents, "text", load_digit_embedder), "doc_id")


def embed_once(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that reach the model when all documents are embedded, and again with other French ones, through one store."""
    store = f"{scratch_dir(spark)}/vectors"
    documents = _documents(spark, folder).select("doc_id", "lang", "text")
    changed = F.when(F.col("lang") == "fr", F.concat(F.col("text"), F.lit(" fin"))).otherwise(F.col("text"))
    seen, out = 0, []
    for number, rows in enumerate((documents, documents.withColumn("text", changed)), 1):
        found = write_once(embed_distinct(rows, "text", load_digit_embedder, store))
        inputs = spark.read.parquet(store).count()
        sums = found.agg(F.count("*").alias("n_rows"), F.sum(F.aggregate(
            "embedding", F.lit(0.0), lambda s, v: s + v)).cast("bigint").alias("n_tokens"))
        out.append(sums.select(F.lit(number).cast("bigint").alias("run"), "n_rows", F.lit(inputs - seen).cast("bigint").alias("n_inputs"), "n_tokens"))
        seen = inputs
    return out[0].unionByName(out[1])


def embed_native(spark: SparkSession, folder: str) -> DataFrame:
    return _dimensions(_documents(spark, folder), "doc_id", digit_embedding(F.col("text")))


def embed_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks streamed twice, the second time with old and new French texts in one batch; a second source has the pages' texts."""
    work = scratch_dir(spark)

    def sync(rows: DataFrame, name: str, mode: str, url: str, order: str | None = None) -> None:
        rows.write.mode(mode).parquet(f"{work}/{name}")
        stream = spark.readStream.schema(rows.schema).parquet(f"{work}/{name}")
        sync_embeddings(stream, f"{work}/sync", f"{work}/checkpoint-{name}", load_digit_embedder, url, order)

    first = _chunks(spark, folder).withColumn("edition", F.lit(1))
    sync(first, "chunks", "append", "doc_id", "edition")
    changed = F.when(F.col("lang") == "fr", F.concat(F.col("content"), F.lit(" fin"))).otherwise(F.col("content"))
    second = first.withColumns({"content": changed, "edition": F.lit(2)})
    sync(second.unionByName(first.filter("lang = 'fr'")), "chunks", "overwrite", "doc_id", "edition")
    pages = table(spark, folder, "pages").select(F.concat(F.lit("page "), "page_id").alias("url"), "url", F.col("url").alias("text"))
    sync(chunk_rows(pages.toDF("path", "address", "text").drop("address"), "text", "path"), "pages", "append", "path")
    return _dimensions(read_sync_table(spark, f"{work}/sync"), "id")


QUERIES = {
    "t1_html_text": lambda s, d: extract(
        spread_table(s, d, "pages").select("page_id", F.encode("html", "UTF-8").alias("content")), "html"
    ).select("page_id", F.md5(clean_pages(F.col("pages"))).alias("text_md5")),
    "t2a_collapse_whitespace": _step(collapse_whitespace),
    "t2b_join_hyphenated": _step(join_hyphenated),
    "t2c_tighten_punctuation": _step(tighten_punctuation),
    "t2d_trim": lambda s, d: _documents(s, d).select(
        "doc_id", F.trim(F.concat(F.lit("  "), F.col("text"), F.lit(" "))).alias("cleaned")),
    "t2_clean_text": _step(clean_text),
    "t3_clean_pages": lambda s, d: _paged(s, d).select(
        "doc_id", clean_pages(split_pages(F.col("text"))).alias("cleaned")),
    "t4_failed_parse": failed_parse,
    "k1_chunks": lambda s, d: plain(_chunks(s, d).select("id", "doc_id", "chunk_pos", "content")),
    "k1_chunks_paged": lambda s, d: plain(
        chunk_rows(_paged(s, d), "text", "doc_id").select("doc_id", "chunk_pos", "content")),
    "k2_sentences": lambda s, d: plain(_documents(s, d).select(
        "doc_id", F.posexplode(sentences(clean_text(F.col("text")))).alias("pos", "sentence"))),
    "k3_token_count": lambda s, d: _documents(s, d).select(
        "doc_id", word_count(clean_text(F.col("text"))).cast("bigint").alias("n_tokens")),
    "k3_tokenizer_chunks": lambda s, d: plain(chunk_rows(
        _documents(s, d).select("doc_id", "text"), "text", "doc_id", encoder_splitter(load_word_encoder)
    ).select("doc_id", "chunk_pos", "content")),
    "k4_chunk_rows": lambda s, d: plain(_chunks(s, d).select("id", "doc_id", "lang", "source", "chunk_pos")),
    "k5_token_windows": lambda s, d: plain(chunk_rows(
        _documents(s, d).select("doc_id", "text"), "text", "doc_id", token_windows
    ).select("doc_id", "chunk_pos", "content")),
    "k7_chunk_report": lambda s, d: chunk_report(_chunks(s, d), "source"),
    "k8_context_check": lambda s, d: context_check(table(s, d, "conversations"), 100, 512),
    "e1_embed_udf": embed_udf,
    "e1_embed_native": embed_native,
    "e1_embed_distinct": embed_once,
    "e4_embed_stream": embed_stream,
    "e6_request_payloads": lambda s, d: request_payloads(_documents(s, d), "doc_id", "text").select(
        "bucket", "batch", "n_rows", F.md5("payload").alias("payload_md5")),
}

_DOC_CHUNKS = sql_chunks("SELECT doc_id AS key, text FROM documents")
_NOISY = sql_noise("text")
_HTML = (
    "regexp_replace(regexp_replace(html, '(?is)<script\\b.*?</script>|<style\\b.*?</style>|<!--.*?-->', ' ', 'g'), "
    "'<[^>]*>', ' ', 'g')"
)
for _entity, _char in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&copy;", "©"), ("&middot;", "·"),
                      ("&amp;", "&")]:
    _HTML = f"replace({_HTML}, '{_entity}', '{_char}')"
_VECTORS = f"WITH {sql_vectors('vec', 'SELECT doc_id AS id, text FROM documents')} SELECT id AS doc_id, dim, v FROM vec"

ORACLES = {
    "t1_html_text": f"SELECT page_id, md5({sql_clean(_HTML)}) AS text_md5 FROM pages",
    "t2a_collapse_whitespace": f"SELECT doc_id, regexp_replace({_NOISY}, '\\s+', ' ', 'g') AS cleaned FROM documents",
    "t2b_join_hyphenated": f"SELECT doc_id, regexp_replace({_NOISY}, '-\\s+', '', 'g') AS cleaned FROM documents",
    "t2c_tighten_punctuation":
        f"SELECT doc_id, regexp_replace({_NOISY}, '\\s+([.,;:!?])', '\\1', 'g') AS cleaned FROM documents",
    "t2d_trim": "SELECT doc_id, trim('  ' || text || ' ') AS cleaned FROM documents",
    "t2_clean_text": f"SELECT doc_id, {sql_clean(_NOISY)} AS cleaned FROM documents",
    "t3_clean_pages": f"""SELECT doc_id, array_to_string(
      list_transform(string_split(text, chr(10)), lambda p: {sql_clean('p')}), chr(10) || chr(10)) AS cleaned
      FROM documents""",
    "t4_failed_parse": "SELECT doc_id, CASE WHEN lang = 'fr' THEN 'rejected' ELSE 'chunked' END AS outcome FROM documents",
    "k1_chunks": f"""WITH RECURSIVE {_DOC_CHUNKS}
      SELECT {sql_id('key', 'chunk_pos')} AS id, key AS doc_id, chunk_pos, content FROM chunks""",
    "k1_chunks_paged": f"""WITH RECURSIVE
      {sql_chunks("SELECT doc_id AS key, replace(text, chr(10), chr(12)) AS text FROM documents")}
      SELECT key AS doc_id, chunk_pos, content FROM chunks""",
    "k2_sentences": f"""SELECT doc_id, (generate_subscripts(parts, 1) - 1)::BIGINT AS pos, unnest(parts) AS sentence
      FROM (SELECT doc_id, list_filter(string_split(regexp_replace({sql_clean('text')}, '([.!?]) +', '\\1' || chr(1), 'g'),
        chr(1)), lambda x: x <> '') AS parts FROM documents)""",
    "k3_token_count": f"""SELECT doc_id, CASE WHEN c = '' THEN 0 ELSE len(string_split(c, ' ')) END::BIGINT AS n_tokens
      FROM (SELECT doc_id, {sql_clean('text')} AS c FROM documents)""",
    "k3_tokenizer_chunks": f"WITH RECURSIVE {_DOC_CHUNKS} SELECT key AS doc_id, chunk_pos, content FROM chunks",
    "k4_chunk_rows": f"""WITH RECURSIVE {_DOC_CHUNKS}
      SELECT {sql_id('key', 'chunk_pos')} AS id, doc_id, lang, source, chunk_pos
      FROM chunks JOIN documents ON doc_id = key""",
    "k5_token_windows": f"""SELECT doc_id, i::BIGINT AS chunk_pos, array_to_string(ws[i * 490 + 1:i * 490 + 500], ' ') AS content
      FROM (SELECT doc_id, ws, unnest(range(greatest((len(ws) - 10 + 489) // 490, 1))) AS i
        FROM (SELECT doc_id, string_split({sql_clean('text')}, ' ') AS ws FROM documents) WHERE ws <> [''])""",
    "k7_chunk_report": f"""WITH RECURSIVE {_DOC_CHUNKS},
      counted AS (SELECT source, len(string_split(content, ' '))::BIGINT AS n FROM chunks JOIN documents ON doc_id = key)
      SELECT source, count(*) AS n_chunks, min(n) AS min_tokens, median(n) AS median_tokens, max(n) AS max_tokens
      FROM counted GROUP BY 1""",
    "k8_context_check": f"""SELECT conv_id, sum({sql_tokens('text')})::BIGINT AS n_tokens,
      sum({sql_tokens('text')}) + 100 <= 512 AS fits FROM conversations GROUP BY 1""",
    "e1_embed_udf": _VECTORS,
    "e1_embed_native": _VECTORS,
    "e1_embed_distinct": """WITH t AS (
        SELECT 1 AS run, text FROM documents
        UNION ALL SELECT 2, CASE WHEN lang = 'fr' THEN text || ' fin' ELSE text END FROM documents)
      SELECT run::BIGINT AS run, count(*) AS n_rows,
        (count(DISTINCT text) FILTER (run = 1 OR text NOT IN (SELECT text FROM documents)))::BIGINT AS n_inputs,
        sum(len(regexp_extract_all(text, '\\S+')))::BIGINT AS n_tokens FROM t GROUP BY run""",
    "e4_embed_stream": f"""WITH RECURSIVE {_DOC_CHUNKS},
      rows AS (
        SELECT {sql_id('key', 'chunk_pos')} AS id, CASE WHEN lang = 'fr' THEN content || ' fin' ELSE content END AS text
        FROM chunks JOIN documents ON doc_id = key
        UNION ALL SELECT {sql_id("'page ' || page_id", '0')}, url FROM pages),
      {sql_vectors('vec', "SELECT id, text FROM rows")}
      SELECT id, dim, v FROM vec""",
    "e6_request_payloads": f"""WITH b AS (SELECT greatest(1, (count(*) + 2399) // 2400) AS n FROM documents),
      k AS (SELECT doc_id, text, {sql_bucket('doc_id', 'n')} AS bucket FROM documents, b),
      r AS (SELECT *, (row_number() OVER (PARTITION BY bucket ORDER BY doc_id) - 1) // 150 AS batch FROM k)
      SELECT bucket::BIGINT AS bucket, batch::BIGINT AS batch, count(*) AS n_rows,
        md5(to_json({{'columns': ['text'], 'index': list(doc_id ORDER BY doc_id), 'data': list([text] ORDER BY doc_id)}})
          ::VARCHAR) AS payload_md5 FROM r GROUP BY 1, 2""",
}
