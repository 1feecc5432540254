"""The queries of the subpackage: thin rows over the operators, with equivalent SQL where there is one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.llm import (
    bpe, chat_format, collocations, decontamination, embedding_dedup, license_scan, ngram_join, periodic_runs, pii, quality,
    substring_dedup, suffix_dedup, token_counts,
)
from passagework.session import write_once

#: Least score of a document that counts as good.
GOOD = 0.3
#: Most tokens of a document that is not over the limit.
TOKEN_LIMIT = 512


def read(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def joined_hash(items) -> F.Column:
    """SHA-256 of the comma-joined items."""
    return F.sha2(F.array_join(items, ",").cast("binary"), 256)


def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation from the view of each of its participants."""
    found = chat_format.rotate_perspectives(read(spark, folder, "conversations", "conv_id", "turn", "role", "text"))
    spans = F.transform("mask", lambda m: F.concat_ws(":", m["start"].cast("string"), m["end"].cast("string")))
    return found.select("conv_id", "speaker", "part", "n_messages", "rendered", F.array_join(spans, ",").alias("mask"))


OP1_SQL = """
WITH message AS (
  SELECT conv_id, coalesce(nullif(role, ''), 'unknown') AS speaker, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(nullif(role, ''), 'unknown'),
                            coalesce(text, '')) - 1 AS number
  FROM conversations),
view AS (SELECT DISTINCT conv_id, speaker FROM message WHERE speaker <> 'system'),
piece AS (
  SELECT v.conv_id, v.speaker, number // 64 AS part, number, m.speaker = v.speaker AS own,
         '<|im_start|>' || CASE WHEN m.speaker = 'system' THEN 'system' WHEN m.speaker = v.speaker THEN 'assistant'
           ELSE 'user name=' || m.speaker END || chr(10) AS head,
         text || '<|im_end|>' AS body
  FROM view v JOIN message m ON m.conv_id IS NOT DISTINCT FROM v.conv_id),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
      PARTITION BY conv_id, speaker, part ORDER BY number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
    + length(head) AS begins FROM piece)
SELECT conv_id, speaker, part, count(*) AS n_messages,
       string_agg(head || body || chr(10), '' ORDER BY number) AS rendered,
       coalesce(string_agg(begins::BIGINT || ':' || (begins + length(body))::BIGINT, ',' ORDER BY number) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, speaker, part
"""


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document: spans that rules prove, and those that boosted trees add."""
    docs = read(spark, folder, "documents", "doc_id", "text")
    found = pii.find_pii(docs, pii.fit(docs))

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == pii.KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, pii.BASE), F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Licence families named in every document, and the number of paragraphs that do."""
    docs = read(spark, folder, "documents", "doc_id", "text")
    found = license_scan.scan_licenses(docs, license_scan.fit(docs))
    return found.select(
        "doc_id", F.size("licenses").cast("bigint").alias("n_paragraphs"),
        F.array_join(F.array_sort(F.array_distinct("licenses.family")), ",").alias("families"))


def op4_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document by the ranks of a public vocabulary, and their bytes again."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = bpe.encode_and_decode(read(spark, folder, "documents", "doc_id", "text"), path, public_tokenizers.PATTERN)
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), joined_hash(F.col("ids")).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in a window of ten words of a benchmark item."""
    found = decontamination.find_contamination(
        read(spark, folder, "documents", "doc_id", "text"), read(spark, folder, "benchmark", "item_id", "text"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        joined_hash(F.col("items")).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP6_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, m, array_to_string(ws[i:i + m - 1], ' ') AS w
  FROM (SELECT item_id, ws, least(len(ws), 10) AS m, unnest(range(1, greatest(len(ws) - 8, 2))) AS i
        FROM item WHERE len(ws) > 0)),
doc_window AS (
  SELECT r, m, i, array_to_string(ws[i:i + m - 1], ' ') AS w
  FROM (SELECT r, ws, m, unnest(range(1, greatest(len(ws) - m + 2, 1))) AS i
        FROM doc CROSS JOIN (SELECT DISTINCT m FROM item_window))),
found AS (SELECT r, d.m, i, item_id FROM doc_window d JOIN item_window b ON b.m = d.m AND b.w = d.w),
hit AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT r, i, unnest(range(m)) AS k FROM found) GROUP BY r),
items AS (
  SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from the labels of four folds of five."""
    stats = write_once(quality.document_stats(read(spark, folder, "documents", "doc_id", "text")).drop("text"))
    model = quality.fit(quality.labelled(stats, read(spark, folder, "labels", "doc_id", "quality")))
    return quality.score_stats(stats, model).select(
        "doc_id", (quality.fold("doc_id") == 0).alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the strings of 400 bytes that start twice or more."""
    found = suffix_dedup.remove_repeated_bytes(read(spark, folder, "documents", "doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Documents without the windows of 35 words that start twice or more."""
    found = substring_dedup.remove_repeated_words(read(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP9_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
place AS (
  SELECT r, i, array_to_string(ws[i:i + 34], ' ') AS w
  FROM (SELECT r, ws, unnest(range(1, greatest(len(ws) - 33, 1))) AS i FROM doc)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY w) AS n FROM place) WHERE n > 1),
word AS (SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM doc),
edge AS (SELECT r, i, sum(d) AS d FROM (
  SELECT r, i, 1 AS d FROM again UNION ALL SELECT r, i + 35, -1 FROM again) GROUP BY r, i),
depth AS (
  SELECT r, i, w, sum(coalesce(d, 0)) OVER (PARTITION BY r ORDER BY i) AS d
  FROM word LEFT JOIN edge USING (r, i)),
kept AS (
  SELECT r, count(*) FILTER (d > 0) AS gone, string_agg(w, ' ' ORDER BY i) FILTER (d <= 0) AS body
  FROM depth GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (r)
"""

def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, as connected classes."""
    return ngram_join.similar_documents(read(spark, folder, "documents", "doc_id", "text"))


OP5_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM doc WHERE len(ws) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
link AS (
  SELECT a, b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingle x JOIN shingle y USING (s)
    WHERE x.doc_id <> y.doc_id GROUP BY ALL) JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
  WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles,
       (SELECT count(*) FROM link WHERE link.a = doc.doc_id)::BIGINT AS n_links, component_id
FROM doc LEFT JOIN size USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""

def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of one label with a cosine of 0.98 or more, as connected classes."""
    found = embedding_dedup.link_vectors(read(spark, folder, "embeddings", "vec_id", "embedding", "label"))
    return found.select("vec_id", "n_links", "component_id", "kept")


OP10_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
link AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y USING (label)
  WHERE x.vec_id <> y.vec_id AND list_cosine_similarity(x.v, y.v) >= 0.98),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = vec_id)::BIGINT AS n_links, component_id,
       vec_id = component_id AS kept
FROM embeddings JOIN (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a) USING (vec_id)
"""

def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document, from the counts at all of its prefixes."""
    import public_tokenizers

    docs = read(spark, folder, "documents", "doc_id", "text")
    counted = token_counts.prefix_counts(docs, public_tokenizers.path("byte_bpe_50k.json"))
    tokens = token_counts.total_tokens(F.col("counts"))
    return counted.select(
        "doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint").alias("n_bytes"), tokens.alias("n_tokens"),
        (tokens > TOKEN_LIMIT).alias("over_limit"))


def planted(text: Column, doc_id: Column) -> Column:
    """The words of a text; from a place on, those of one in ten documents follow a period. Both are set by the id."""
    text = F.coalesce(text, F.lit(""))
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeat(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p))), " ")

    made = F.transform(F.array(F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))), lambda words: F.when(
        F.size(words) > 0, repeat(words)).otherwise(""))[0]
    return F.when(h % 10 == 0, made).otherwise(text)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Stretches of words of every document that repeat with a period, and what is left without the repeats."""
    docs = read(spark, folder, "documents", "doc_id", "text")
    found = periodic_runs.find_runs(docs.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text")))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    found = found.withColumns({"_listed": F.array_join(listed, ""), "_best": best})
    start, length, period = -F.col("_best.start"), F.col("_best.length"), -F.col("_best.period")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.col("_listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The phrases of two and three words of each language whose words keep together most."""
    return collocations.find_collocations(read(spark, folder, "documents", "text", "lang"))


OP13_SQL = r"""
WITH piece AS (
  SELECT row_number() OVER () AS r, lang, body FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS body FROM documents)),
spelled AS (SELECT lang, regexp_extract_all(body, '[^\x20\x09]+') AS ws FROM piece),
phrase AS (
  SELECT lang, m, ws[i:i + m - 1] AS p, count(*)::HUGEINT AS f
  FROM (SELECT lang, ws, m, unnest(range(1, greatest(len(ws) - m + 2, 1))) AS i FROM spelled CROSS JOIN (VALUES (1), (2), (3)) v(m))
  GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM phrase WHERE m = 1 GROUP BY lang),
candidate AS (SELECT lang, m, p, f AS a FROM phrase WHERE m > 1 AND f >= 10),
cut AS (
  SELECT c.lang, c.p, a, k, x.f AS l, y.f AS r, (1000000 * a * a) // (x.f * y.f) AS score
  FROM (SELECT *, p[1:k] AS head, p[k + 1:] AS tail FROM (SELECT *, unnest(range(1, m)) AS k FROM candidate)) c
  JOIN phrase x ON x.lang = c.lang AND x.p = head JOIN phrase y ON y.lang = c.lang AND y.p = tail),
worst AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS place FROM cut) WHERE place = 1),
inside AS (
  SELECT lang, p, max(a) AS longer FROM (
    SELECT lang, a, unnest([p[1:2], p[2:3]]) AS p FROM candidate WHERE m = 3) GROUP BY ALL),
named AS (
  SELECT w.lang, array_to_string(w.p, ' ') AS phrase, a, l, r, score
  FROM worst w LEFT JOIN inside i ON i.lang = w.lang AND i.p = w.p WHERE longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM named)
JOIN total USING (lang) WHERE rank <= 2000
"""

QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_pii": op2_pii,
    "op3_license_scan": op3_license_scan,
    "op4_bpe": op4_bpe,
    "op5_ngram_join": op5_ngram_join,
    "op6_decontamination": op6_decontamination,
    "op7_quality": op7_quality,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_embedding_dedup": op10_embedding_dedup,
    "op11_token_counts": op11_token_counts,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_collocations": op13_collocations,
}

ORACLES = {
    "op1_chat_format": OP1_SQL,
    "op5_ngram_join": OP5_SQL,
    "op6_decontamination": OP6_SQL,
    "op9_substring_dedup": OP9_SQL,
    "op10_embedding_dedup": OP10_SQL,
    "op13_collocations": OP13_SQL,
}
