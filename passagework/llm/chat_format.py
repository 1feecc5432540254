"""Multi-party chat formatting: the dialogue from the view of every participant.

For each speaker of a conversation the dialogue is rendered with that speaker as assistant, the other speakers as users
with their names, and system messages as they are. ``mask`` marks the stretches of the rendering that a model should
learn: the texts of the assistant with the end mark after each.

Messages are ordered by turn (null first), speaker and text, and numbered in that order. A rendering comes in parts of
``part`` messages, so a conversation of any length is whole and no row holds more than that. The numbers come from a sort of
the distinct messages by range: rows are numbered within their stretch, and the counts of the stretches before are added.
So one conversation may hold any share of all rows. Only column functions, joins and windows are used.

Cases: a null text is an empty message, a null or empty speaker is named ``unknown``; messages with a null conversation
id are a conversation of their own. Repeated rows are messages each. A conversation with system messages only has no
participants and so no rows. Marks inside texts are not altered; the mask tells them apart. Empty tables give empty
results. Other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passagework.session import write_once

PART = 64
#: Fixed values of the chat markup.
START, END = "<|im_start|>", "<|im_end|>"


def number_messages(messages: DataFrame) -> DataFrame:
    """``conv``, ``speaker``, ``text`` and ``number``, the place of each message in its conversation from 0 on."""
    order = ["conv", "turn", "speaker", "text"]
    parts = max(int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    distinct = messages.groupBy(*order).agg(F.count("*").alias("copies"))
    placed = write_once(distinct.repartitionByRange(parts, *order).withColumn("stretch", F.spark_partition_id()))
    inside = Window.partitionBy("conv", "stretch").orderBy("turn", "speaker", "text")
    before = F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    counts = placed.groupBy("conv", "stretch").agg(F.sum("copies").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("conv").alias("_conv"), F.col("stretch").alias("_stretch"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("stretch") == F.col("_stretch"))
    first = placed.withColumn("before", F.coalesce(before, F.lit(0))).join(counts, same)
    return first.withColumn("first", F.col("offset") + F.col("before")).select(
        "conv", "speaker", "text", F.explode(F.sequence("first", F.col("first") + F.col("copies") - 1)).alias("number"))


def _header(of: Column, view: Column, system: Column) -> Column:
    who = F.when(system, F.lit("system")).when(of == view, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), of))
    return F.concat(F.lit(START), who, F.lit("\n"))


def rotate_perspectives(
    df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
    system: tuple[str, ...] = ("system",), part: int = PART,
) -> DataFrame:
    """Per conversation, participant and part: conv_id, ``speaker``, ``part``, ``n_messages``, ``rendered`` and ``mask``.

    ``mask`` is an array of ``start`` and ``end`` in code points of ``rendered``.
    """
    messages = df.select(
        F.col(conv_id).alias("conv"), F.col(turn).alias("turn"),
        F.coalesce(F.nullif(F.col(speaker).cast("string"), F.lit("")), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(text), F.lit("")).alias("text"))
    numbered = number_messages(messages)
    grouped = numbered.groupBy("conv", F.floor(F.col("number") / part).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("number", "speaker", "text"))).alias("m"))
    views = messages.filter(~F.col("speaker").isin(*system)).select(
        F.col("conv").alias("_conv"), F.col("speaker").alias("view")).distinct()
    both = grouped.join(views, F.col("conv").eqNullSafe(F.col("_conv")))
    both = both.withColumn("pieces", F.transform("m", lambda m: F.struct(
        _header(m["speaker"], F.col("view"), m["speaker"].isin(*system)).alias("head"),
        F.concat(m["text"], F.lit(END)).alias("body"), (m["speaker"] == F.col("view")).alias("own"))))
    sizes = F.transform("pieces", lambda p: F.length(p["head"]) + F.length(p["body"]) + 1)
    both = both.withColumn("sizes", sizes)

    def span(p: Column, i: Column) -> Column:
        start = F.aggregate(F.slice("sizes", F.lit(1), i), F.lit(0), lambda a, v: a + v) + F.length(p["head"])
        return F.struct(p["own"].alias("own"), start.alias("start"), (start + F.length(p["body"])).alias("end"))

    spans = F.transform("pieces", span)
    return both.select(
        F.col("conv").alias(conv_id), F.col("view").alias("speaker"), "part", F.size("m").cast("bigint").alias("n_messages"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("rendered"),
        F.transform(F.filter(spans, lambda s: s["own"]), lambda s: F.struct(s["start"], s["end"])).alias("mask"))
