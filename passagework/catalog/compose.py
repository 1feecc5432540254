"""Templates, chains, fan-out, derived inputs and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from passagework.catalog.common import load_stub_generator, sql_stub, table
from passagework.functions.templates import fill
from passagework.operators.compose import (
    classify_and_answer, fan_out, normalise_label, parallel, prompt_step, route,
)


def two_stage(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    first = prompt_step(rows, "Describe a use of the part {p_name}.", load_stub_generator, "use")
    return prompt_step(first, "Estimate a price for {use} by {p_brand}", load_stub_generator, "price").select(
        "p_partkey", "price")


def several(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    return fan_out(
        rows, {"summary": "Sum up the message: {text}", "subject": "Name the subject of: {text}"}, load_stub_generator
    ).select("conv_id", "turn", "summary", "subject")


def passed_along(spark: SparkSession, folder: str) -> DataFrame:
    num = F.col("l_linenumber")
    rows = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    nested = parallel(
        rows, passed={}, extra={"mult": num * 3}, modified=num + 1
    )
    return nested.select(
        F.col("passed.l_orderkey").alias("l_orderkey"),
        F.col("passed.l_linenumber").cast("bigint").alias("num"),
        F.col("extra.l_linenumber").cast("bigint").alias("extra_num"),
        F.col("extra.mult").cast("bigint").alias("mult"),
        F.col("modified").cast("bigint").alias("modified"),
    )


def lengths(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select(
        "p_partkey", F.length("p_name").alias("a"), (F.length("p_name") * F.length("p_brand")).alias("b"))
    return rows.select("p_partkey", fill("name of {a} letters, {b} with its brand", a="a", b="b").alias("prompt"))


def routed(spark: SparkSession, folder: str) -> DataFrame:
    """Event types as labels; a type that no branch names takes the default."""
    label = F.concat(F.lit("\n "), F.upper("event_type"), F.lit(" \n"))
    rows = table(spark, folder, "events").select("event_id", label.alias("label"))
    branches = {"purchase": F.lit("sales"), "error": F.lit("support"), "c": F.lit("usage")}
    return rows.select(
        "event_id", normalise_label(F.col("label")).alias("label"),
        route(F.col("label"), branches, F.lit("general")).alias("branch"))


def classified(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", F.col("event_type").alias("question"))
    return classify_and_answer(
        rows, "Name the kind of: {question}",
        {"kind of: click": "Explain the click of {topic}", "kind of: e": "Repair: {question}"},
        "Reply to {question}", load_stub_generator,
    ).select("event_id", "topic", "answer")


QUERIES = {
    "c1_template": lambda s, d: table(s, d, "part").select(
        "p_partkey",
        fill("{{{p_name}}} by {p_brand}, size {p_size}: {p_name}", p_name="p_name", p_brand="p_brand", p_size="p_size")
        .alias("filled")),
    "c2_two_stage_chain": two_stage,
    "c3_fan_out": several,
    "c4_pass_and_assign": passed_along,
    "c5_field_lengths": lengths,
    "c6_route": routed,
    "c6_classify_and_answer": classified,
    "c7_normalise_label": lambda s, d: table(s, d, "events").select(
        "event_id", normalise_label(F.concat(F.lit(" \t"), F.upper("event_type"), F.lit("\n"))).alias("label")),
}

_USE = sql_stub("('Describe a use of the part ' || p_name || '.')")
_TOPIC = sql_stub("('Name the kind of: ' || event_type)")

ORACLES = {
    "c1_template": """SELECT p_partkey, '{' || p_name || '} by ' || p_brand || ', size ' || p_size || ': ' || p_name
      AS filled FROM part""",
    "c2_two_stage_chain": f"""SELECT p_partkey, {sql_stub("('Estimate a price for ' || use || ' by ' || p_brand)")}
      AS price FROM (SELECT *, {_USE} AS use FROM part)""",
    "c3_fan_out": f"""SELECT conv_id, turn, {sql_stub("('Sum up the message: ' || text)")} AS summary,
      {sql_stub("('Name the subject of: ' || text)")} AS subject FROM conversations""",
    "c4_pass_and_assign": """SELECT l_orderkey, l_linenumber::BIGINT AS num, l_linenumber::BIGINT AS extra_num,
      (l_linenumber * 3)::BIGINT AS mult, (l_linenumber + 1)::BIGINT AS modified FROM lineitem""",
    "c5_field_lengths": """SELECT p_partkey, 'name of ' || length(p_name) || ' letters, ' || length(p_name) * length(p_brand)
      || ' with its brand' AS prompt FROM part""",
    "c6_route": """SELECT event_id, lower(event_type) AS label, CASE WHEN event_type = 'purchase' THEN 'sales'
      WHEN event_type = 'error' THEN 'support' WHEN event_type = 'click' THEN 'usage' ELSE 'general' END AS branch
      FROM events""",
    "c6_classify_and_answer": f"""SELECT event_id, topic, CASE
        WHEN event_type = 'click' THEN {sql_stub("('Explain the click of ' || topic)")}
        WHEN event_type = 'error' THEN {sql_stub("('Repair: ' || event_type)")}
        ELSE {sql_stub("('Reply to ' || event_type)")} END AS answer
      FROM (SELECT *, {_TOPIC} AS topic FROM events)""",
    "c7_normalise_label": "SELECT event_id, lower(event_type) AS label FROM events",
}
