"""Conversations: questions, histories, prompts and memory.

Conversations arrive as rows ``conv_id, turn, role, text``; a turn occurs once in a conversation. Everything that needs
no folding works on rows. What a model must receive in one piece is folded to one record per conversation, whatever its
length, out of ordered runs, so no task sorts a whole long conversation. Whether a record fits the model's context is
reported and never changes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passagework.functions.templates import fill
from passagework.functions.text import tokens
from passagework.operators.chunking import CONTEXT_TOKENS
from passagework.session import is_small, write_once

# Turns of a conversation that are put in order at a time.
RUN_TURNS = 256


def message_tokens(text: Column) -> Column:
    """Tokens of a raw text, at least 1, BIGINT: runs of characters that are not white space."""
    return F.greatest(F.size(tokens(F.coalesce(text, F.lit("")))), F.lit(1)).cast("bigint")


def conversation_sizes(messages: DataFrame) -> DataFrame:
    """``conv_id, n_messages, n_tokens, last_turn``: one small row per conversation, aggregated before the shuffle."""
    return messages.groupBy("conv_id").agg(
        F.count("*").alias("n_messages"),
        F.sum(message_tokens(F.col("text"))).alias("n_tokens"),
        F.max("turn").alias("last_turn"),
    )


def last_questions(messages: DataFrame, rule: str = "last") -> DataFrame:
    """``conv_id, question``: the text of the last message, or with ``last_user`` of the last user message.

    Only turns are aggregated; the text comes by a join on conversation and turn, a key that is never hot.
    """
    asked = messages if rule == "last" else messages.filter(F.col("role") == "user")
    last = asked.groupBy("conv_id").agg(F.max("turn").alias("turn"))
    return asked.join(last, ["conv_id", "turn"]).select("conv_id", F.col("text").alias("question"))


def history_rows(messages: DataFrame) -> DataFrame:
    """All messages but the last of each conversation, as rows in any order; the turn is their position."""
    last = messages.groupBy("conv_id").agg(F.max("turn").alias("_last"))
    return messages.join(last, "conv_id").filter(F.col("turn") < F.col("_last")).drop("_last")


def formatted_history_rows(messages: DataFrame) -> DataFrame:
    """History without roles other than user and assistant, each message tagged ``human`` or ``ai``."""
    tag = F.when(F.col("role") == "user", "human").when(F.col("role") == "assistant", "ai")
    return history_rows(messages).withColumn("tag", tag).filter(F.col("tag").isNotNull())


def fold(messages: DataFrame) -> DataFrame:
    """``conv_id, n_messages, n_tokens, messages``: one row per conversation, messages in order of turn.

    Runs of turns are gathered and ordered first, then the runs, so a long conversation is ordered by many tasks.
    """
    runs = messages.groupBy("conv_id", F.floor(F.col("turn") / RUN_TURNS).alias("run")).agg(
        F.count("*").alias("n"),
        F.sum(message_tokens(F.col("text"))).alias("n_tokens"),
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"),
    )
    return runs.groupBy("conv_id").agg(
        F.sum("n").alias("n_messages"),
        F.sum("n_tokens").alias("n_tokens"),
        F.flatten(F.transform(
            F.array_sort(F.collect_list(F.struct("run", "messages"))), lambda r: r["messages"])).alias("messages"),
    )


def question_of(messages: Column, rule: str = "last") -> Column:
    """Question of a folded conversation."""
    asked = messages if rule == "last" else F.filter(messages, lambda m: m["role"] == "user")
    return F.get(asked, F.size(asked) - 1)["text"]


def history_of(messages: Column) -> Column:
    """All messages but the last."""
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))


def formatted_history_of(messages: Column) -> Column:
    """User and assistant messages of the history, ARRAY<STRUCT<role,text>>."""
    kept = F.filter(history_of(messages), lambda m: m["role"].isin("user", "assistant"))
    return F.transform(kept, lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text")))


def rewrite_prompt(history: Column, question: Column, template: str) -> Column:
    """Prompt that turns a history and a question into a search text; NULL where there is no history.

    Tests the raw history, so a lone system message before the question also asks for a rewrite.
    """
    shown = F.to_json(F.transform(history, lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text"))))
    return F.when(F.size(history) > 0, fill(template, chat_history=shown, question=question))


def format_context(hits: DataFrame, key_col: str, text_col: str, uri_col: str, template: str) -> DataFrame:
    """``key, context``: one filled template per hit, joined in order of rank. A key has at most k hits."""
    passage = fill(template, chunk_text=F.col(text_col), document_uri=F.col(uri_col))
    gathered = F.array_sort(F.collect_list(F.struct("rank", passage.alias("passage"))))
    return hits.groupBy(key_col).agg(
        F.array_join(F.transform(gathered, lambda p: p["passage"]), "").alias("context")
    )


def final_messages(system_text: Column, formatted_history: Column, question: Column) -> Column:
    """Messages for the model: system text, formatted history, the question as a user message."""
    def message(role: str, text: Column) -> Column:
        return F.array(F.struct(F.lit(role).alias("role"), F.coalesce(text, F.lit("")).alias("text")))

    return F.concat(message("system", system_text), formatted_history, message("user", question))


def messages_tokens(messages: Column) -> Column:
    """Tokens of all texts of a folded conversation."""
    return F.aggregate(messages, F.lit(0).cast("bigint"), lambda n, m: n + message_tokens(m["text"]))


def context_check(
    messages: DataFrame, max_new_tokens: int = 100, context_tokens: int = CONTEXT_TOKENS
) -> DataFrame:
    """``conv_id, n_tokens, fits``: whether a conversation and its answer stay within the model's context."""
    sizes = conversation_sizes(messages)
    return sizes.select("conv_id", "n_tokens", (F.col("n_tokens") + max_new_tokens <= context_tokens).alias("fits"))


def paged_history(messages: DataFrame) -> DataFrame:
    """``conv_id, page, messages``: the messages of at most ``RUN_TURNS`` consecutive turns, in order.

    A page is put together by a task of its own, however long the conversation is.
    """
    return messages.groupBy("conv_id", F.floor(F.col("turn") / RUN_TURNS).alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))


def with_memory(messages: DataFrame, prompt: Callable[[Column, Column], Column]) -> DataFrame:
    """``conv_id, turn, n_earlier, prompt``: every message with the prompt made from it and all earlier ones.

    ``prompt`` gets the array of earlier messages and the message. Pages are stored once. A turn is a row of its own from the
    start, with the whole pages before its page and the head of its own page, so a task holds one prompt at a time. A
    conversation of one page needs no further shuffle; the pages of a longer one are dealt anew once they know what is before
    them, so its prompts are filled by many tasks: that moves one history per ``RUN_TURNS`` prompts.
    """
    pages = write_once(paged_history(messages))
    long = pages.groupBy(F.col("conv_id").alias("_conv")).agg(F.count("*").alias("_pages")).filter("_pages > 1")
    long = write_once(long.select("_conv"))
    long = F.broadcast(long) if is_small(long) else long
    same = F.col("conv_id").eqNullSafe(F.col("_conv"))
    before = Window.partitionBy("conv_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    alone = pages.join(long, same, "left_anti").select("conv_id", F.slice("messages", 1, 0).alias("earlier"), "messages")
    paged = pages.join(long, same, "left_semi").withColumn("earlier", F.flatten(F.collect_list("messages").over(before)))
    paged = paged.repartition("conv_id", "page").select("conv_id", "earlier", "messages")
    turns = alone.unionByName(paged).select("conv_id", "earlier", "messages", F.posexplode("messages").alias("at", "m"))
    head = F.concat("earlier", F.slice("messages", F.lit(1), F.col("at")))
    return turns.select(
        "conv_id", "m.turn", (F.size("earlier") + F.col("at")).cast("bigint").alias("n_earlier"),
        prompt(head, F.col("m")).alias("prompt"))
