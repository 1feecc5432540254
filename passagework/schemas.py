"""Declared schemas of all tables and requests, and the checks against them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW_FILES = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])

CHUNKS = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("chunk_pos", T.IntegerType()),
    T.StructField("content", T.StringType()),
])

SYNC_TABLE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("embedding", T.ArrayType(T.FloatType())),
])

MESSAGE = T.StructType([
    T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
])

CONVERSATIONS = T.StructType([T.StructField("conv_id", T.LongType()), *MESSAGE.fields])

GENERATION_REQUEST = T.StructType([
    T.StructField("prompt", T.StringType()),
    T.StructField("system_prompt", T.StringType()),
    T.StructField("temperature", T.DoubleType()),
    T.StructField("max_new_tokens", T.LongType()),
])


class SchemaMismatch(ValueError):
    """A table lacks a declared column or has it with another type."""


def check_columns(df: DataFrame, expected: T.StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """Return ``df`` if it has every declared column with the declared type, else raise."""
    have = {f.name: f.dataType for f in df.schema.fields}
    problems = []
    for want in expected.fields:
        if want.name not in have:
            if want.name not in optional:
                problems.append(f"{want.name} is missing")
        elif have[want.name].simpleString() != want.dataType.simpleString():
            problems.append(
                f"{want.name} is {have[want.name].simpleString()}, expected {want.dataType.simpleString()}"
            )
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df


@dataclass(frozen=True)
class RetrieverConfig:
    """Which columns hold key, text and address of a chunk, and how many chunks a question gets."""

    key_col: str = "id"
    text_col: str = "content"
    uri_col: str = "url"
    k: int = 3
    query_type: str = "exact"
    passage_template: str = "Source text: {chunk_text}\n"

    def __post_init__(self) -> None:
        if self.k < 1:
            raise ValueError("k must be at least 1")
        if self.query_type not in ("exact", "ann"):
            raise ValueError(f"query_type must be 'exact' or 'ann', got {self.query_type!r}")


@dataclass(frozen=True)
class GeneratorConfig:
    """Templates and parameters of the chat model."""

    system_template: str = "Use only these source texts.\n{context}\nThe user asks: {question}"
    rewrite_template: str = "Earlier messages: {chat_history}\nLast message: {question}\nSearch text:"
    temperature: float = 1.0
    max_new_tokens: int = 100
    context_tokens: int = 4096

    def __post_init__(self) -> None:
        if not 0 < self.max_new_tokens < self.context_tokens:
            raise ValueError("max_new_tokens must be positive and below context_tokens")


@dataclass(frozen=True)
class ChainConfig:
    """Configuration of the whole chat chain, checked on construction."""

    retriever: RetrieverConfig = field(default_factory=RetrieverConfig)
    generator: GeneratorConfig = field(default_factory=GeneratorConfig)
    question_rule: str = "last"

    def __post_init__(self) -> None:
        if self.question_rule not in ("last", "last_user"):
            raise ValueError(f"question_rule must be 'last' or 'last_user', got {self.question_rule!r}")

    @classmethod
    def from_dict(cls, values: dict) -> ChainConfig:
        """Build a configuration from nested dictionaries, as read from a YAML or JSON file."""
        parts = dict(values)
        return cls(
            retriever=RetrieverConfig(**parts.pop("retriever", {})),
            generator=GeneratorConfig(**parts.pop("generator", {})),
            **parts,
        )
