"""Shared by the query modules: table access, model stand-ins and SQL fragments."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passagework.sources.tables import spread

# Unique keys of the tables whose rows need costly work.
KEYS = {"documents": "doc_id", "pages": "page_id"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of texts, dealt to all cores before costly work."""
    return spread(table(spark, folder, name), KEYS[name])


def plain(df: DataFrame) -> DataFrame:
    """Widen INT columns to BIGINT, for comparison with SQL."""
    return df.select(*[
        F.col(f.name).cast("bigint").alias(f.name) if isinstance(f.dataType, T.IntegerType) else F.col(f.name)
        for f in df.schema.fields
    ])


def load_stub_generator() -> Callable[[list[dict]], list[str]]:
    """Stand-in for a chat model: the length of the prompt and its last 80 characters."""
    return lambda requests: [f"{len(r['prompt'])}:{r['prompt'][-80:]}" for r in requests]


def load_echo_generator() -> Callable[[list[dict]], list[str]]:
    """Stand-in that repeats the prompt before its reply, as a bare model does."""
    return lambda requests: [
        f"{r['prompt']}{r['temperature']:.1f}/{r['max_new_tokens']}/{len(r['system_prompt'])}" for r in requests
    ]


def load_word_encoder() -> Callable[[list[str]], list[list[tuple[int, int]]]]:
    """Stand-in for a tokenizer: the places of the runs of characters other than the blank."""
    return lambda texts: [[m.span() for m in re.finditer("[^ ]+", text)] for text in texts]


def sql_stub(prompt: str) -> str:
    return f"(length({prompt})::VARCHAR || ':' || right({prompt}, 80))"


def sql_clean(text: str) -> str:
    steps = f"regexp_replace({text}, '\\s+', ' ', 'g')"
    steps = f"regexp_replace({steps}, '-\\s+', '', 'g')"
    return f"trim(regexp_replace({steps}, '\\s+([.,;:!?])', '\\1', 'g'))"


def sql_noise(text: str) -> str:
    """Hyphen breaks and blanks before punctuation, of which the documents have none."""
    broken = f"replace(replace({text}, '. ', ' .  '), 'tion', 'ti-' || chr(10) || ' on')"
    return f"replace({broken}, ', ', ' ,' || chr(9))"


def noise(text: str) -> F.Column:
    broken = F.replace(F.replace(F.col(text), F.lit(". "), F.lit(" .  ")), F.lit("tion"), F.lit("ti-\n on"))
    return F.replace(broken, F.lit(", "), F.lit(" ,\t"))


def sql_id(*parts: str) -> str:
    joined = " || '#' || ".join(f"{p}::VARCHAR" for p in parts)
    return f"md5({joined})"


def sql_bucket(key: str, buckets: str) -> str:
    return f"(('0x' || substr(md5({key}::VARCHAR), 1, 15))::BIGINT % {buckets})"


def sql_tokens(text: str) -> str:
    """Tokens of a raw text, at least 1."""
    return f"greatest(len(regexp_extract_all({text}, '\\S+')), 1)::BIGINT"


def sql_chunks(base: str, size: int = 500, overlap: int = 10) -> str:
    """CTEs that end in ``chunks(key, chunk_pos, content)`` for a query with ``key, text``."""
    limit = size - overlap
    return f"""
base AS ({base}),
page AS (
  SELECT key, generate_subscripts(string_split(text, chr(12)), 1) AS page_no,
         unnest(string_split(text, chr(12))) AS body FROM base),
sentence AS (
  SELECT key, page_no, generate_subscripts(parts, 1) AS sent_no, unnest(parts) AS body
  FROM (SELECT key, page_no, string_split(
          regexp_replace({sql_clean('body')}, '([.!?]) +', '\\1' || chr(1), 'g'), chr(1)) AS parts FROM page)),
tokens AS (
  SELECT key, page_no, sent_no, string_split(body, ' ') AS ws FROM sentence WHERE body <> ''),
cut AS (
  SELECT key, page_no, sent_no, i, array_to_string(ws[i * {limit} + 1:(i + 1) * {limit}], ' ') AS body,
         least(len(ws) - i * {limit}, {limit}) AS n
  FROM (SELECT *, unnest(range((len(ws) + {limit} - 1) // {limit})) AS i FROM tokens)),
piece AS (
  SELECT key, body, n, row_number() OVER (PARTITION BY key ORDER BY page_no, sent_no, i) AS pos FROM cut),
walk AS (
  SELECT key, pos, n AS filled, 0 AS chunk FROM piece WHERE pos = 1
  UNION ALL
  SELECT p.key, p.pos, CASE WHEN w.filled + p.n > {limit} THEN p.n ELSE w.filled + p.n END,
         CASE WHEN w.filled + p.n > {limit} THEN w.chunk + 1 ELSE w.chunk END
  FROM walk w JOIN piece p ON p.key = w.key AND p.pos = w.pos + 1),
packed AS (
  SELECT key, chunk, string_agg(body, ' ' ORDER BY pos) AS body
  FROM walk JOIN piece USING (key, pos) GROUP BY key, chunk),
chunks AS (
  SELECT key, chunk::BIGINT AS chunk_pos, CASE WHEN chunk = 0 THEN body ELSE
    array_to_string((string_split(lag(body) OVER (PARTITION BY key ORDER BY chunk), ' '))[-{overlap}:], ' ')
    || ' ' || body END AS content FROM packed)"""


def sql_vectors(name: str, base: str) -> str:
    """CTEs that end in ``<name>(id, dim, v)``, the stand-in embedding of a query with ``id, text``."""
    return f"""
{name}_w AS (SELECT id, unnest(regexp_extract_all(text, '\\S+')) AS w FROM ({base})),
{name} AS (
  SELECT id, left(md5(lower(w)), 1) AS dim, count(*)::DOUBLE AS v FROM {name}_w GROUP BY ALL)"""


def sql_nearest(index: str, queries: str, k: int = 3) -> str:
    """CTE ``hits(query_id, rank, id, score)`` from two vector CTEs."""
    return f"""
index_norm AS (SELECT id, sqrt(sum(v * v)) AS n FROM {index} GROUP BY id),
query_norm AS (SELECT id, sqrt(sum(v * v)) AS n FROM {queries} GROUP BY id),
scored AS (
  SELECT q.id AS query_id, i.id, sum(q.v * i.v) AS dot FROM {queries} q JOIN {index} i USING (dim) GROUP BY ALL),
every_pair AS (
  SELECT a.id AS query_id, b.id, round(coalesce(dot, 0) / (b.n * a.n), 6) AS score
  FROM query_norm a CROSS JOIN index_norm b LEFT JOIN scored s ON s.query_id = a.id AND s.id = b.id),
hits AS (
  SELECT * FROM (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score
                 FROM every_pair) WHERE rank <= {k})"""
