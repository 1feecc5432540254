"""Text expressions. Every function takes and returns a Column and stays inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Unicode-aware regular expressions treat as white space, blank aside.
# Java's own \s covers only the first five. The wide ones stand behind one range test, which most letters fail.
_WIDE_SPACE = r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
OTHER_SPACE = r"\t\n\x0B\f\r\x1c\x1d\x1e\x1f\x85\xa0" + _WIDE_SPACE
ANY_SPACE = f"[ {OTHER_SPACE}]"

# A lone blank is already in its final form; matching only the other runs saves one replacement per word.
_RUN = f"[{OTHER_SPACE}]{ANY_SPACE}*| {ANY_SPACE}+"

# Fixed value: marks the end of a page inside one text.
PAGE_BREAK = "\f"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``.

    Catalyst inlines a column that a lambda mentions once, although the lambda runs once per element.
    A one-element array keeps the value outside the lambda that loops.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def collapse_whitespace(text: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(text, _RUN, " ")


def join_hyphenated(text: Column) -> Column:
    """Remove a hyphen and the white space after it. Also joins spaced dashes: ``a - b`` gives ``a b``."""
    return F.regexp_replace(text, f"-{ANY_SPACE}+", "")


def tighten_punctuation(text: Column) -> Column:
    """Remove white space before ``. , ; : ! ?``."""
    return F.regexp_replace(text, f"{ANY_SPACE}+([.,;:!?])", "$1")


def clean_text(text: Column) -> Column:
    """Collapse white space, join hyphenated words, tighten punctuation and trim, in this order.

    After the first step only single blanks are left, so the other steps need no regular expression for them.
    """
    joined = F.replace(collapse_whitespace(text), F.lit("- "), F.lit(""))
    return F.trim(F.regexp_replace(joined, " ([.,;:!?])", "$1"))


def clean_pages(pages: Column) -> Column:
    """Clean each page on its own and join the pages with an empty line."""
    return F.array_join(F.transform(pages, clean_text), "\n\n")


def split_pages(text: Column) -> Column:
    """Split a text at its page breaks."""
    return F.split(text, PAGE_BREAK)


def words(cleaned: Column) -> Column:
    """Tokens of a cleaned text: its runs of non-blank characters. Empty for an empty text."""
    return F.array_remove(F.split(cleaned, " "), "")


def tokens(text: Column) -> Column:
    """Tokens of a raw text: its runs of characters that are not white space."""
    return F.array_remove(F.split(text, f"{ANY_SPACE}+"), "")


def word_count(cleaned: Column) -> Column:
    """Number of tokens in a cleaned text, without building them: its blanks, each one byte, and one."""
    blanks = F.octet_length(cleaned) - F.octet_length(F.replace(cleaned, F.lit(" "), F.lit("")))
    return F.when(cleaned == "", F.lit(0)).otherwise(blanks + 1)


def sentences(cleaned: Column) -> Column:
    """Sentences of a cleaned text: a sentence ends at ``. ! ?`` followed by a blank."""
    return F.array_remove(F.split(cleaned, "(?<=[.!?]) "), "")


def stable_id(*parts: Column) -> Column:
    """STRING key made from its parts alone: the 32 hex digits of the MD5 of ``a#b#...``.

    Needs no global counter, and a rerun gives every row the same key. All 128 bits are kept: at some 1e10 keys
    64 bits would already collide.
    """
    return F.md5(F.concat_ws("#", *[p.cast("string") for p in parts]))


def hash_bucket(key: Column, buckets: Column) -> Column:
    """Number of the bucket of a key, by the first 60 bits of its MD5."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 15), 16, 10).cast("bigint"), buckets)
