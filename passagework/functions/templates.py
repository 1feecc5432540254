"""Text templates as column expressions."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F


def template_fields(template: str) -> list[str]:
    """Names of the variables of a template, in order of first use."""
    return list(dict.fromkeys(name for _, name, _, _ in Formatter().parse(template) if name is not None))


def fill(template: str, **values: Column | str) -> Column:
    """The template with ``{name}`` replaced by the column of that name; ``{{`` and ``}}`` are plain braces.

    The template is parsed once, into one concatenation, so a placeholder inside the data stays as it is. A NULL
    value becomes an empty text.
    """
    missing = [name for name in template_fields(template) if name not in values]
    if missing:
        raise KeyError(f"no value for {', '.join(missing)}")
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            value = values[name]
            value = F.col(value) if isinstance(value, str) else value
            parts.append(F.coalesce(value.cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def chat_markup(system_prompt: Column, instruction: Column) -> Column:
    """System text and instruction in the markup of the chat model."""
    # The markup that the model was trained with.
    return F.concat(
        F.lit("<s>[INST]<<SYS>>\n"), F.coalesce(system_prompt, F.lit("")),
        F.lit("\n<</SYS>>\n\n\n"), F.coalesce(instruction, F.lit("")), F.lit("[/INST]\n"),
    )


def strip_echo(output: Column, prompt: Column) -> Column:
    """The output of a model without the prompt that it repeats at the start."""
    return F.when(F.startswith(output, prompt), F.substr(output, F.length(prompt) + 1)).otherwise(output)
