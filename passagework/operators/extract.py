"""From file bytes to page texts and chunks."""

from __future__ import annotations

import html
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagework.functions.text import PAGE_BREAK, split_pages
from passagework.operators.chunking import chunk_rows, chunk_text
from passagework.session import arrow_batches, write_once

# Most files, and bytes of files after which a batch ends, that go to Python at a time.
BATCH_ROWS, BATCH_BYTES = 100, 64 << 20

# From a BINARY column to ARRAY<STRING>, one element per page, NULL if the bytes cannot be read.
Extractor = Callable[[Column], Column]


def utf8_pages(content: Column) -> Column:
    """Pages of a UTF-8 text file, split at form feeds. Invalid bytes give NULL."""
    return split_pages(F.try_validate_utf8(content.cast("string")))


# What is no text in a page, found in one pass: comments, scripts and styles with all they hold, and tags. The end of a tag is
# not looked for inside a quoted value; what is not closed ends with the page. Nothing is taken back once it is matched.
_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z))?+)*+"""
_MARKUP = re.compile(
    rf"<!--(?:.*?-->|.*)|<(script|style)\b{_ATTRIBUTES}(?:\Z|>.*?(?:</\1\b[^>]*+(?:>|\Z)|\Z))|<[a-z/!?]{_ATTRIBUTES}(?:>|\Z)",
    re.IGNORECASE | re.DOTALL)


def visible_text(page: str) -> str:
    """Text of an HTML page: markup becomes a blank, and all named and numbered entities are decoded, once."""
    return html.unescape(_MARKUP.sub(" ", page))


def html_pages(content: Column) -> Column:
    """Visible text of an HTML file, as one page. Invalid UTF-8 gives NULL."""

    def page(raw: bytes | None) -> list[str] | None:
        if raw is None:
            return None
        try:
            return [visible_text(bytes(raw).decode())]
        except UnicodeDecodeError:
            return None

    @F.pandas_udf("array<string>")
    def pages(batch: pd.Series) -> pd.Series:
        return pd.Series([page(raw) for raw in batch], dtype=object)

    return pages(content)


# Names of the built-in extractors. Formats that need a parser take a pandas UDF instead.
EXTRACTORS: dict[str, Extractor] = {"utf8": utf8_pages, "html": html_pages}


def extract(raw: DataFrame, extractor: str | Extractor, content_col: str = "content") -> DataFrame:
    """Replace the bytes by ``pages``. ``extractor`` is a built-in name or a function such as a pandas UDF."""
    pages = EXTRACTORS[extractor] if isinstance(extractor, str) else extractor
    kept = [c for c in raw.columns if c != content_col]
    return raw.select(*kept, pages(F.col(content_col)).alias("pages"))


def rejects(extracted: DataFrame) -> DataFrame:
    """Rows whose bytes could not be read. They give no chunk, so they are listed here."""
    kept = [c for c in extracted.columns if c != "pages"]
    return extracted.filter(F.col("pages").isNull()).select(*kept, F.lit("unreadable content").alias("reason"))


def chunk_files(
    raw: DataFrame,
    extractor: str | Extractor,
    splitter: Callable[[Column], Column] = chunk_text,
    path_col: str = "path",
) -> DataFrame:
    """Chunks of a raw file table: extract, clean, split, one row per chunk with the other columns kept."""
    pages = extract(raw, extractor)
    kept = [c for c in pages.columns if c != "pages"]
    # a page break inside a page is white space there, not a page edge
    bodies = F.transform("pages", lambda page: F.replace(page, F.lit(PAGE_BREAK), F.lit(" ")))
    texts = pages.select(*kept, F.array_join(bodies, PAGE_BREAK).alias("text"))
    return chunk_rows(texts, "text", path_col, splitter)


def write_chunks(
    raw: DataFrame,
    extractor: str | Extractor,
    splitter: Callable[[Column], Column] = chunk_text,
    path_col: str = "path",
    path: str | None = None,
    batch_rows: int = BATCH_ROWS,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``chunk_files``, run and written, with few files at a time in a Python extractor or tokenizer.

    A batch ends at ``batch_rows`` files or once it holds ``batch_bytes``, so a worker never holds many large files at a time.
    """
    with arrow_batches(raw.sparkSession, batch_rows, batch_bytes):
        return write_once(chunk_files(raw, extractor, splitter, path_col), path)
