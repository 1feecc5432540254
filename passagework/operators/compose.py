"""Multi-step prompts: chains, fan-out, derived inputs and routing."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.functions.templates import fill, template_fields
from passagework.functions.text import ANY_SPACE
from passagework.operators.generation import Generator, generate, generate_named

LoadGenerator = Callable[[], Generator]


def _values(df: DataFrame, template: str) -> dict[str, Column]:
    unknown = [f for f in template_fields(template) if f not in df.columns]
    if unknown:
        raise KeyError(f"the table has no column {', '.join(unknown)}")
    return {f: F.col(f) for f in template_fields(template)}


def prompt_step(
    df: DataFrame, template: str | Column, load_generator: LoadGenerator, out_col: str, system_prompt: str = ""
) -> DataFrame:
    """Fill the template from the row, ask the model, add the answer. Steps chain by naming earlier answers."""
    prompt = template if isinstance(template, Column) else fill(template, **_values(df, template))
    asked = df.withColumns({"prompt": prompt, "system_prompt": F.lit(system_prompt)})
    return generate(asked, load_generator, "_answer").select(*df.columns, F.col("_answer").alias(out_col))


def fan_out(df: DataFrame, templates: Mapping[str, str], load_generator: LoadGenerator) -> DataFrame:
    """Several templates over the same row, one answer column per name."""
    prompts = {name: fill(t, **_values(df, t)) for name, t in templates.items()}
    return generate_named(df, prompts, load_generator)


def parallel(df: DataFrame, **results: Column | Mapping[str, Column]) -> DataFrame:
    """Named results over the same input row.

    A column is a result of its own. A mapping is the input row, passed through as a struct, with the mapping's
    columns added; an empty mapping passes the row through unchanged.
    """
    def build(value: Column | Mapping[str, Column]) -> Column:
        if isinstance(value, Column):
            return value
        kept = [F.col(c) for c in df.columns if c not in value]
        return F.struct(*kept, *[v.alias(n) for n, v in value.items()])

    return df.select(*[build(v).alias(name) for name, v in results.items()])


def normalise_label(label: Column) -> Column:
    """Lower case, without white space at either end."""
    return F.regexp_replace(F.lower(label), f"^{ANY_SPACE}+|{ANY_SPACE}+$", "")


def route(label: Column, branches: Mapping[str, Column], default: Column) -> Column:
    """Value of the first branch whose key occurs in the normalised label, else the default."""
    name = normalise_label(label)
    chosen = None
    for key, value in branches.items():
        test = F.contains(name, F.lit(key))
        chosen = F.when(test, value) if chosen is None else chosen.when(test, value)
    return default if chosen is None else chosen.otherwise(default)


def classify_and_answer(
    df: DataFrame,
    classify_template: str,
    branches: Mapping[str, str],
    default_template: str,
    load_generator: LoadGenerator,
    label_col: str = "topic",
    out_col: str = "answer",
) -> DataFrame:
    """Let the model label each row, pick the template by the label, and ask once more.

    The label chooses among prompts, not among models, so each row is sent to the model twice and no more.
    """
    labelled = prompt_step(df, classify_template, load_generator, label_col)
    prompts = {key: fill(t, **_values(labelled, t)) for key, t in branches.items()}
    default = fill(default_template, **_values(labelled, default_template))
    return prompt_step(labelled, route(F.col(label_col), prompts, default), load_generator, out_col)
