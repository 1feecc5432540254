"""Batch generation through a caller-supplied model."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.functions.templates import chat_markup, strip_echo
from passagework.schemas import GENERATION_REQUEST, check_columns

# A request has the keys prompt, system_prompt, temperature and max_new_tokens.
Generator = Callable[[list[dict]], list[str]]

DEFAULT_TEMPERATURE = 1.0
DEFAULT_MAX_NEW_TOKENS = 100
MAX_CALL = 64


def with_defaults(
    df: DataFrame, temperature: float = DEFAULT_TEMPERATURE, max_new_tokens: int = DEFAULT_MAX_NEW_TOKENS
) -> DataFrame:
    """Fill ``temperature`` and ``max_new_tokens`` where they are NULL, or add them, for every row."""
    def filled(name: str, kind: str, default: float) -> Column:
        value = F.lit(default).cast(kind)
        return F.coalesce(F.col(name), value) if name in df.columns else value

    return df.withColumns({
        "temperature": filled("temperature", "double", temperature),
        "max_new_tokens": filled("max_new_tokens", "bigint", max_new_tokens),
    })


def _call(model: Generator, requests: list[dict], max_call: int) -> list[str]:
    out: list[str] = []
    for start in range(0, len(requests), max_call):
        call = requests[start:start + max_call]
        got = list(model(call))
        if len(got) != len(call):
            raise ValueError(f"the model returned {len(got)} texts for {len(call)} requests")
        out += got
    return out


def generate(
    df: DataFrame, load_generator: Callable[[], Generator], out_col: str = "completion", max_call: int = MAX_CALL
) -> DataFrame:
    """Add one completion per row to a table with the columns of a generation request.

    Only the request goes to Python. ``load_generator`` runs once per Python task; a row with a NULL prompt is not
    sent and gets NULL. Write the result before using it twice: a recomputed plan calls the model again.
    """
    requests = with_defaults(check_columns(df, GENERATION_REQUEST, optional=("temperature", "max_new_tokens")))

    @F.pandas_udf("string")
    def complete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = load_generator()
        for batch in batches:
            out = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            sent = batch[batch["prompt"].notna()]
            if len(sent):
                out.loc[sent.index] = _call(model, sent.to_dict("records"), max_call)
            yield out

    fields = F.struct(*GENERATION_REQUEST.names)
    return requests.withColumn(out_col, complete.asNondeterministic()(fields)).select(*df.columns, out_col)


def predict(
    df: DataFrame, load_generator: Callable[[], Generator], out_col: str = "completion", max_call: int = MAX_CALL
) -> DataFrame:
    """``generate`` for a bare model: wraps system text and prompt in chat markup, drops the echoed prompt."""
    marked = df.withColumn("_asked", F.col("prompt")).withColumn(
        "prompt", F.when(F.col("prompt").isNotNull(), chat_markup(F.col("system_prompt"), F.col("prompt")))
    )
    answered = generate(marked, load_generator, "_output", max_call)
    return answered.withColumn(out_col, strip_echo(F.col("_output"), F.col("prompt"))).withColumn(
        "prompt", F.col("_asked")
    ).select(*df.columns, out_col)


def generate_named(
    df: DataFrame,
    prompts: dict[str, Column],
    load_generator: Callable[[], Generator],
    system_prompt: str = "",
    temperature: float = DEFAULT_TEMPERATURE,
    max_new_tokens: int = DEFAULT_MAX_NEW_TOKENS,
    max_call: int = MAX_CALL,
) -> DataFrame:
    """Several prompts per row, one result column per name.

    The prompts of a row travel as one array and come back as one, in a single pass: no explode, no pivot.
    """
    names = list(prompts)

    @F.pandas_udf("array<string>")
    def complete(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_generator()
        for batch in batches:
            flat = [
                {"prompt": p, "system_prompt": system_prompt, "temperature": temperature,
                 "max_new_tokens": max_new_tokens}
                for row in batch for p in row
            ]
            got = _call(model, flat, max_call)
            width = len(names)
            yield pd.Series([got[i * width:(i + 1) * width] for i in range(len(batch))], index=batch.index)

    answered = df.withColumn("_answers", complete.asNondeterministic()(F.array(*prompts.values())))
    return answered.select(*df.columns, *[F.col("_answers")[i].alias(name) for i, name in enumerate(names)])
