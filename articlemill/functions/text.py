"""Tokens, sentences and other text expressions, as native Spark columns.

Patterns use only syntax that Java regex and RE2 read alike.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

LETTERS = "A-Za-z"
LETTERS_DIGITS = "A-Za-z0-9"
NON_SPACE = "[^ \\t\\r\\n]+"
# ASCII ranges come first, as they are tested faster than Unicode classes.
WORD_OR_MARK = "[A-Za-z0-9\\p{L}\\p{N}]+|[^A-Za-z0-9\\p{L}\\p{N} \\t\\r\\n]"
# A run of end marks at the start of a text is a sentence of its own.
SENTENCE = "[^.!?]+[.!?]*|[.!?]+"


def keep_only(text: Column, pattern: str, separator: str = "") -> Column:
    """The matches of a pattern, joined; several times faster than deleting the rest."""
    return F.array_join(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), separator)


def squeeze(text: Column) -> Column:
    """Runs of whitespace become one blank; none is left at the ends."""
    return keep_only(text, NON_SPACE, " ")


def raw_tokens(text: Column, keep: str = LETTERS, separator: str = "") -> Column:
    """Lowercase tokens of the kept characters; may hold empty strings.

    Other characters are deleted, which joins what they stood between, unless
    `separator=" "` is given. For row form, explode and drop the empty tokens.
    """
    return F.split(F.lower(keep_only(text, f"[{keep} ]+", separator)), " ")


def tokens(text: Column, keep: str = LETTERS, separator: str = "") -> Column:
    return F.filter(raw_tokens(text, keep, separator), lambda t: t != "")


def without_words(token_array: Column, words: Iterable[str]) -> Column:
    """Tokens that are not in the list, order and duplicates kept."""
    listed = list(words)
    return F.filter(token_array, lambda t: ~t.isin(listed))


def without_words_any_case(token_array: Column, words: Iterable[str]) -> Column:
    listed = list(words)
    return F.filter(token_array, lambda t: ~F.lower(t).isin(listed))


def word_tokens(text: Column) -> Column:
    """Words and single punctuation marks, case kept."""
    return F.regexp_extract_all(text, F.lit(WORD_OR_MARK), F.lit(0))


def sentences(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))


def covered_text(text: Column, begin: Column, end: Column) -> Column:
    """Text between 0-based offsets, the end exclusive."""
    return F.substring(text, begin + 1, end - begin)


def slice_joined(token_array: Column, start: Column | int, end: Column | int) -> Column:
    """Tokens from `start` up to but without `end`, joined by blanks."""
    first = F.lit(start) if isinstance(start, int) else start
    last = F.lit(end) if isinstance(end, int) else end
    return F.array_join(F.slice(token_array, first + 1, last - first), " ")


def first_chars(text: Column, n: int) -> Column:
    return F.left(text, F.lit(n))


def last_chars_reversed(text: Column, n: int) -> Column:
    return F.reverse(F.right(text, F.lit(n)))


def base64_pair(left: Column, right: Column) -> Column:
    return F.base64(F.encode(F.concat_ws(":", left, right), "UTF-8"))
