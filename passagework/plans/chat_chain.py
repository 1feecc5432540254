"""The chat chain over many conversations: question, rewrite, retrieval, context, prompt, answer."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from passagework.functions.templates import fill
from passagework.operators.chat import (
    final_messages,
    fold,
    format_context,
    formatted_history_of,
    history_of,
    messages_tokens,
    question_of,
    rewrite_prompt,
)
from passagework.operators.embedding import Embedder
from passagework.operators.generation import Generator, generate
from passagework.operators.search import approximate_search, similarity_search
from passagework.plans.retrieval import Embedding, model_embedding
from passagework.schemas import CONVERSATIONS, ChainConfig, check_columns
from passagework.session import write_once

# Search for the hits of ``query_id, embedding``: returns ``query_id, rank, id, <columns>, score``.
Search = Callable[[DataFrame, int, list[str]], DataFrame]


def chat_inputs(conversations: DataFrame, config: ChainConfig = ChainConfig()) -> DataFrame:
    """``conv_id, n_tokens, question, history, formatted_history``: one row per conversation of any length."""
    folded = fold(check_columns(conversations, CONVERSATIONS))
    messages = F.col("messages")
    return folded.select(
        "conv_id", "n_tokens",
        question_of(messages, config.question_rule).alias("question"),
        history_of(messages).alias("history"),
        formatted_history_of(messages).alias("formatted_history"),
    )


def search_texts(
    inputs: DataFrame, load_generator: Callable[[], Generator], config: ChainConfig = ChainConfig()
) -> DataFrame:
    """Add ``search_text``: the question, rewritten by the model where there is a history.

    Rows without history have a NULL prompt, which is never sent: one pass serves both branches.
    """
    prompt = rewrite_prompt(F.col("history"), F.col("question"), config.generator.rewrite_template)
    asked = inputs.withColumns({
        "prompt": prompt,
        "system_prompt": F.lit(""),
        "temperature": F.lit(config.generator.temperature),
        "max_new_tokens": F.lit(config.generator.max_new_tokens).cast("bigint"),
    })
    rewritten = generate(asked, load_generator, "_rewritten")
    text = F.when(F.size("history") > 0, F.col("_rewritten")).otherwise(F.col("question"))
    return rewritten.select(*inputs.columns, text.alias("search_text"))


def index_search(
    index: DataFrame, config: ChainConfig = ChainConfig(), lists: np.ndarray | None = None, n_probe: int = 8
) -> Search:
    """Search of an index as the configuration says: exact, or ``ann`` over an index that has been given lists."""
    key = config.retriever.key_col
    if config.retriever.query_type == "exact":
        return lambda queries, k, columns: similarity_search(index, queries, k, columns, id_col=key)
    if lists is None:
        raise ValueError("query_type 'ann' needs the centres of the lists that the index was divided by")
    return lambda queries, k, columns: approximate_search(index, lists, queries, k, n_probe, columns, id_col=key)


def retrieve(
    texts: DataFrame, search: Search, embedding: Embedding, config: ChainConfig = ChainConfig()
) -> DataFrame:
    """Hits of every search text, keyed by ``(conv_id, rank)``: also the table for a review of the chunks."""
    asked = texts.filter(F.col("search_text").isNotNull()).select(F.col("conv_id").alias("query_id"), "search_text")
    queries = embedding(asked, "search_text").select("query_id", "embedding")
    r = config.retriever
    return search(queries, r.k, [r.text_col, r.uri_col]).withColumnRenamed("query_id", "conv_id")


def prompts(texts: DataFrame, hits: DataFrame, config: ChainConfig = ChainConfig()) -> DataFrame:
    """Add ``context``, the final ``messages``, their ``n_tokens`` and ``overflow`` to every conversation.

    ``overflow`` reports that messages and answer exceed the model's context. Nothing is shortened or left out for it.
    """
    r, g = config.retriever, config.generator
    context = format_context(hits, "conv_id", r.text_col, r.uri_col, r.passage_template)
    joined = texts.join(context, "conv_id", "left")
    system = fill(g.system_template, context=F.col("context"), question=F.col("question"))
    built = joined.withColumn("messages", final_messages(system, F.col("formatted_history"), F.col("question")))
    built = built.withColumn("n_tokens", messages_tokens(F.col("messages")))
    return built.withColumn("overflow", F.col("n_tokens") + g.max_new_tokens > g.context_tokens)


def answers(
    prompted: DataFrame, load_generator: Callable[[], Generator], config: ChainConfig = ChainConfig()
) -> DataFrame:
    """Add ``answer``: the model's reply to the messages as JSON, for every conversation."""
    g = config.generator
    asked = prompted.withColumns({
        "prompt": F.to_json("messages"),
        "system_prompt": F.lit(""),
        "temperature": F.lit(g.temperature),
        "max_new_tokens": F.lit(g.max_new_tokens).cast("bigint"),
    })
    return generate(asked, load_generator, "answer").select(*prompted.columns, "answer")


def run_chain(
    conversations: DataFrame,
    search: Search,
    load_embedder: Callable[[], Embedder],
    load_generator: Callable[[], Generator],
    config: ChainConfig = ChainConfig(),
) -> tuple[DataFrame, DataFrame]:
    """Answer every conversation. Returns the answers and the retrieved chunks.

    Whatever a model produced is written before it is used again, so no call is repeated.
    """
    texts = write_once(search_texts(chat_inputs(conversations, config), load_generator, config))
    hits = write_once(retrieve(texts, search, model_embedding(load_embedder), config))
    return write_once(answers(prompts(texts, hits, config), load_generator, config)), hits
