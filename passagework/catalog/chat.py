"""Conversations and the chat chain."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.catalog.common import (
    load_echo_generator, load_stub_generator, plain, spread_table, sql_chunks, sql_id, sql_nearest, sql_stub, sql_tokens,
    sql_vectors, table,
)
from passagework.functions.templates import chat_markup, strip_echo
from passagework.functions.vectors import digit_embedding, load_digit_embedder
from passagework.operators.chat import (
    fold, formatted_history_rows, history_rows, last_questions, rewrite_prompt, with_memory,
)
from passagework.operators.generation import predict, with_defaults
from passagework.plans.chat_chain import (
    chat_inputs, index_search, prompts, retrieve, run_chain, search_texts,
)
from passagework.plans.retrieval import embedded_chunks, expression_embedding
from passagework.schemas import ChainConfig, GeneratorConfig
from passagework.session import write_once

CONFIG = ChainConfig()
NATIVE = expression_embedding(digit_embedding)
# Small enough that some conversations of the tables exceed it, which is reported.
TIGHT = ChainConfig(generator=GeneratorConfig(context_tokens=500))


def _conversations(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations, and every 64 of them once more as one long conversation."""
    rows = table(spark, folder, "conversations")
    long = rows.withColumns({
        "conv_id": -1_000_000 - F.floor(F.col("conv_id") / 64), "turn": F.pmod("conv_id", F.lit(64)) * 1000 + F.col("turn")})
    return rows.unionByName(long)


def folded(spark: SparkSession, folder: str) -> DataFrame:
    rows = fold(_conversations(spark, folder))
    return rows.select("conv_id", "n_messages", "n_tokens", F.md5(F.to_json("messages")).alias("messages_md5"))


def rewrites(spark: SparkSession, folder: str) -> DataFrame:
    inputs = chat_inputs(_conversations(spark, folder), CONFIG)
    prompt = rewrite_prompt(F.col("history"), F.col("question"), CONFIG.generator.rewrite_template)
    return inputs.select("conv_id", prompt.alias("prompt"))


def branched(spark: SparkSession, folder: str) -> DataFrame:
    """With every opening message as a conversation of its own, which has no history and needs no rewrite."""
    inputs = chat_inputs(_first_messages(spark, folder), CONFIG)
    return search_texts(inputs, load_stub_generator, CONFIG).select("conv_id", "search_text")


def _first_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as they are, and each opening message once more as a conversation of its own."""
    rows = table(spark, folder, "conversations")
    openings = rows.filter("turn = 0").withColumn("conv_id", -F.col("conv_id") - 1)
    return rows.unionByName(openings)


def _index(spark: SparkSession, folder: str) -> DataFrame:
    documents = spread_table(spark, folder, "documents").select(F.col("doc_id").alias("url"), "text")
    return embedded_chunks(documents, "text", "url", NATIVE)


def _retrieved(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    inputs = chat_inputs(_conversations(spark, folder), CONFIG)
    texts = write_once(search_texts(inputs, load_stub_generator, CONFIG))
    return texts, write_once(retrieve(texts, index_search(_index(spark, folder)), NATIVE, CONFIG))


def retrieved(spark: SparkSession, folder: str) -> DataFrame:
    return plain(_retrieved(spark, folder)[1])


def contexts(spark: SparkSession, folder: str) -> DataFrame:
    texts, hits = _retrieved(spark, folder)
    return prompts(texts, hits, CONFIG).select("conv_id", F.md5("context").alias("context_md5"))


def final_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """The whole final messages, with the retrieved context."""
    texts, hits = _retrieved(spark, folder)
    return prompts(texts, hits, CONFIG).select("conv_id", F.md5(F.to_json("messages")).alias("messages_md5"))


def full_chain(config: ChainConfig):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        answered, _ = run_chain(
            _conversations(spark, folder), index_search(_index(spark, folder)), load_digit_embedder,
            load_stub_generator, config,
        )
        return answered.select(
            "conv_id", "search_text", "n_tokens", "overflow", F.md5(F.to_json("messages")).alias("messages_md5"), "answer")

    return run


def review_records(spark: SparkSession, folder: str) -> DataFrame:
    """The chunks that the chain retrieved, for a human review: key, text and address per conversation and rank."""
    _, hits = run_chain(
        _conversations(spark, folder), index_search(_index(spark, folder)), load_digit_embedder,
        load_stub_generator, CONFIG,
    )
    return plain(hits.select("conv_id", "rank", "id", "content", "url"))


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    """A generation request per message; system messages leave the parameters open."""
    open_ = F.col("role") == "system"
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", F.col("text").alias("prompt"), F.col("role").alias("system_prompt"),
        F.when(~open_, F.lit(0.5)).alias("temperature"),
        F.when(~open_, F.col("turn") + 10).alias("max_new_tokens"),
    )


def memory(spark: SparkSession, folder: str) -> DataFrame:
    """For every message the prompt of all earlier ones and itself."""
    rows = with_memory(_conversations(spark, folder), lambda earlier, m: F.md5(F.concat(F.to_json(earlier), m["text"])))
    return rows.select("conv_id", "turn", "n_earlier", F.col("prompt").alias("prompt_md5"))


QUERIES = {
    "r0_folded_requests": folded,
    "r1_last_question": lambda s, d: last_questions(_conversations(s, d)),
    "r1_last_user_question": lambda s, d: last_questions(_conversations(s, d), "last_user"),
    "r2_history": lambda s, d: history_rows(_conversations(s, d)),
    "r3_formatted_history": lambda s, d: formatted_history_rows(_conversations(s, d)).select(
        "conv_id", "turn", "tag", "text"),
    "r4_rewrite_prompt": rewrites,
    "r5_branched_rewrite": branched,
    "r6_retrieved_chunks": retrieved,
    "r7_context": contexts,
    "r8_final_prompt": final_prompts,
    "r9_full_chain": full_chain(CONFIG),
    "r9_full_chain_tight_context": full_chain(TIGHT),
    "r11_review_records": review_records,
    "c8_memory": memory,
    "l1_chat_markup": lambda s, d: _requests(s, d).select(
        "conv_id", "turn", chat_markup(F.col("system_prompt"), F.col("prompt")).alias("marked")),
    "l2_defaults": lambda s, d: with_defaults(_requests(s, d)).select(
        "conv_id", "turn", "temperature", "max_new_tokens"),
    "l3_predict": lambda s, d: predict(_requests(s, d), load_echo_generator).select("conv_id", "turn", "completion"),
    "l4_strip_echo": lambda s, d: _requests(s, d).select(
        "conv_id", "turn",
        strip_echo(
            F.when(F.col("system_prompt") == "user", F.concat(F.col("prompt"), F.lit(" yes")))
            .otherwise(F.lit("no echo")), F.col("prompt")).alias("reply")),
}

_TALK = """talk AS (
  SELECT * FROM conversations
  UNION ALL SELECT -1000000 - conv_id // 64, conv_id % 64 * 1000 + turn, role, text FROM conversations)"""
_ORDERED = """ordered AS (
  SELECT conv_id, list({'turn': turn, 'role': role, 'text': text} ORDER BY turn) AS m FROM talk GROUP BY 1),
inputs AS (SELECT conv_id, m[-1].text AS question, m[:-2] AS history FROM ordered),
shaped AS (
  SELECT conv_id, question, len(history) AS n_history,
    list_transform(history, lambda x: {'role': x.role, 'text': x.text}) AS h,
    list_transform(list_filter(history, lambda x: x.role IN ('user', 'assistant')),
      lambda x: {'role': x.role, 'text': x.text}) AS f FROM inputs)"""
_REWRITE = """('Earlier messages: ' || to_json(h)::VARCHAR || chr(10) || 'Last message: ' || question || chr(10)
  || 'Search text:')"""


_TEXTS = f"""{_ORDERED},
texts AS (SELECT *, CASE WHEN n_history > 0 THEN {sql_stub(_REWRITE)} ELSE question END AS search_text FROM shaped)"""
_KEYED = f"SELECT {sql_id('key', 'chunk_pos')} AS id, content AS text FROM chunks"
_HITS = f"""WITH RECURSIVE {sql_chunks("SELECT doc_id AS key, text FROM documents")},
{_TALK}, {_TEXTS},
{sql_vectors('idx', _KEYED)}, {sql_vectors('qry', 'SELECT conv_id AS id, search_text AS text FROM texts')},
{sql_nearest('idx', 'qry')},
keyed AS (SELECT {sql_id('key', 'chunk_pos')} AS id, key AS url, content FROM chunks),
found AS (SELECT query_id AS conv_id, rank, id, content, url, score FROM hits JOIN keyed USING (id)),
contexts AS (
  SELECT conv_id, string_agg('Source text: ' || content || chr(10), '' ORDER BY rank) AS context FROM found GROUP BY 1)"""
_SYSTEM = """('Use only these source texts.' || chr(10) || coalesce(context, '') || chr(10) || 'The user asks: '
      || question)"""
_BUILT = f"""{_HITS},
built AS (
  SELECT t.conv_id, search_text, list_concat(list_concat([{{'role': 'system', 'text': {_SYSTEM}}}], f),
    [{{'role': 'user', 'text': question}}]) AS m
  FROM texts t LEFT JOIN contexts USING (conv_id))"""


def _sql_chain(limit: int) -> str:
    return f"""{_BUILT},
counted AS (
  SELECT conv_id, search_text, m AS final, list_sum(list_transform(m, lambda x: {sql_tokens('x.text')}))::BIGINT AS n FROM built)
SELECT conv_id, search_text, n AS n_tokens, n + 100 > {limit} AS overflow, md5(to_json(final)::VARCHAR) AS messages_md5,
  {sql_stub('to_json(final)::VARCHAR')} AS answer
FROM counted"""


_MARKED = """'<s>[INST]<<SYS>>' || chr(10) || role || chr(10) || '<</SYS>>' || chr(10) || chr(10) || chr(10) || text
  || '[/INST]' || chr(10)"""

ORACLES = {
    "r0_folded_requests": f"""WITH {_TALK}
      SELECT conv_id, count(*) AS n_messages, sum({sql_tokens('text')})::BIGINT AS n_tokens,
        md5(to_json(list({{'turn': turn, 'role': role, 'text': text}} ORDER BY turn))::VARCHAR) AS messages_md5
      FROM talk GROUP BY 1""",
    "r1_last_question": f"WITH {_TALK} SELECT conv_id, arg_max(text, turn) AS question FROM talk GROUP BY 1",
    "r1_last_user_question":
        f"WITH {_TALK} SELECT conv_id, arg_max(text, turn) AS question FROM talk WHERE role = 'user' GROUP BY 1",
    "r2_history": f"""WITH {_TALK} SELECT * FROM talk c
      WHERE turn < (SELECT max(turn) FROM talk d WHERE d.conv_id = c.conv_id)""",
    "r3_formatted_history": f"""WITH {_TALK}
      SELECT conv_id, turn, CASE role WHEN 'user' THEN 'human' ELSE 'ai' END AS tag, text
      FROM talk c WHERE role IN ('user', 'assistant')
      AND turn < (SELECT max(turn) FROM talk d WHERE d.conv_id = c.conv_id)""",
    "r4_rewrite_prompt": f"""WITH {_TALK}, {_ORDERED}
      SELECT conv_id, CASE WHEN n_history > 0 THEN {_REWRITE} END AS prompt FROM shaped""",
    "r5_branched_rewrite": f"""WITH {_TALK.split('UNION ALL')[0]}), {_TEXTS} SELECT conv_id, search_text FROM texts
      UNION ALL SELECT -conv_id - 1, text FROM conversations WHERE turn = 0""",
    "r6_retrieved_chunks": f"{_HITS} SELECT conv_id, rank, id, content, url, score FROM found",
    "r7_context": f"{_HITS} SELECT conv_id, md5(context) AS context_md5 FROM contexts",
    "r8_final_prompt": f"{_BUILT} SELECT conv_id, md5(to_json(m)::VARCHAR) AS messages_md5 FROM built",
    "r9_full_chain": _sql_chain(4096),
    "r9_full_chain_tight_context": _sql_chain(500),
    "r11_review_records": f"{_HITS} SELECT conv_id, rank, id, content, url FROM found",
    "c8_memory": f"""WITH {_TALK} SELECT conv_id, turn, len(coalesce(m, []))::BIGINT AS n_earlier,
        md5(to_json(coalesce(m, []))::VARCHAR || text) AS prompt_md5
      FROM (SELECT conv_id, turn, text, list({{'turn': turn, 'role': role, 'text': text}}) OVER (
              PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM talk)""",
    "l1_chat_markup": f"SELECT conv_id, turn, {_MARKED} AS marked FROM conversations",
    "l2_defaults": """SELECT conv_id, turn, CASE WHEN role = 'system' THEN 1.0 ELSE 0.5 END::DOUBLE AS temperature,
      CASE WHEN role = 'system' THEN 100 ELSE turn + 10 END::BIGINT AS max_new_tokens FROM conversations""",
    "l3_predict": """SELECT conv_id, turn, CASE WHEN role = 'system' THEN '1.0/100/' ELSE '0.5/' || (turn + 10) || '/' END
      || length(role) AS completion FROM conversations""",
    "l4_strip_echo": "SELECT conv_id, turn, CASE role WHEN 'user' THEN ' yes' ELSE 'no echo' END AS reply FROM conversations",
}
