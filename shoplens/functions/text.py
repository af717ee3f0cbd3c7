"""Text features of item titles and stable hashing of ids."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from shoplens.functions.numeric import py_round
from shoplens.schema import (
    CATEGORY_MAP,
    POSITIVE_WORDS,
    TITLE_CATEGORY_DEFAULT,
    TITLE_CATEGORY_RULES,
)


# Unicode white space, as Python's ``split`` sees it.
WHITE_SPACE = "".join(map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
                                0x205F, 0x3000]))


def _lower(text: Column) -> Column:
    return F.lower(F.coalesce(text, F.lit("")))


def _any_contains(lowered: Column, words: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])


def keyword_flag(text: Column, words: list[str]) -> Column:
    """1 when any vocabulary word occurs as a substring of the lower-cased text."""
    return _any_contains(_lower(text), words).cast("int")


def translate_category(raw_category: Column, title: Column) -> Column:
    """Known raw category -> its display name; otherwise the first title keyword rule."""
    mapping = F.create_map(*[F.lit(x) for kv in CATEGORY_MAP.items() for x in kv])
    lowered = _lower(title)
    fallback = F.lit(TITLE_CATEGORY_DEFAULT)
    for words, name in reversed(TITLE_CATEGORY_RULES):
        fallback = F.when(_any_contains(lowered, words), F.lit(name)).otherwise(fallback)
    return F.coalesce(F.try_element_at(mapping, raw_category), fallback)


def token_count(text: Column) -> Column:
    """Number of white-space separated tokens, by Unicode's white space; 1 for none.

    White space becomes single spaces, which are then counted in bytes: no array of
    tokens is built.
    """
    spaced = F.translate(text, WHITE_SPACE, " " * len(WHITE_SPACE))
    single = F.trim(F.regexp_replace(spaced, " {2,}", " "))
    return F.octet_length(single) - F.octet_length(F.replace(single, F.lit(" "), F.lit(""))) + F.lit(1)


def emotion_score(title: Column) -> Column:
    """0.25 + share of positive words per whitespace token (capped at 0.7), 3 decimals.

    An empty title has no positive word and scores 0.25.  Nothing here is conditional, so
    the lower-cased text is worked out once.
    """
    lowered = _lower(title)
    hits = reduce(lambda a, b: a + b, [lowered.contains(w).cast("int") for w in POSITIVE_WORDS])
    return py_round(F.lit(0.25) + F.least(hits / token_count(lowered), F.lit(0.7)), 3)


def stable_hash32(text: Column) -> Column:
    """First 8 hex digits of md5(text) as a non-negative integer."""
    return F.conv(F.substring(F.md5(text.cast("string")), 1, 8), 16, 10).cast("long")


def stable_binary(text: Column) -> Column:
    return (stable_hash32(text) % 2).cast("int")


def stable_bucket(text: Column, size: int) -> Column:
    return (stable_hash32(text) % F.lit(size)).cast("int")
