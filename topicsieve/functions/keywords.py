"""Keyword matching and keyword-list editing."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from topicsieve.functions.text import WORD, strip

_SPECIAL = re.compile(r"([\\.^$|?*+()\[\]{}])")


def whole_word_pattern(needle: str) -> str:
    """Regex for ``needle`` standing between two word boundaries.

    A boundary is a change between word and non-word characters, so a needle
    whose edge is itself a non-word character needs a word character beside it.
    Only consuming groups are used, which keeps the pattern valid on engines
    without look-around.
    """

    before = rf"(?:^|[^{WORD}])" if _is_word(needle[0]) else rf"[{WORD}]"
    after = rf"(?:[^{WORD}]|$)" if _is_word(needle[-1]) else rf"[{WORD}]"
    return before + _SPECIAL.sub(r"\\\1", needle) + after


def _is_word(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def _search_pattern(needle: str) -> str:
    """``whole_word_pattern`` for a search in Spark, which has look-around.

    It begins with the needle, so boundaries are looked at only where that occurs and not
    at every character. Java looks behind by UTF-16 units: with ``.?`` it also begins two
    units before the needle, where a letter above U+FFFF is found whole.
    """
    literal = _SPECIAL.sub(r"\\\1", needle)
    before = rf"(?<{'!' if _is_word(needle[0]) else '='}.?[{WORD}]{literal})"
    return literal + before + rf"(?{'!' if _is_word(needle[-1]) else '='}[{WORD}])"


def keyword_hit(lowered: Column, keyword: str) -> Column:
    """Does the lower-cased text contain ``keyword``?

    Keywords with a space or hyphen match as substrings, others as whole words.
    """
    needle = keyword.lower().strip()
    if not needle:
        return F.lit(False)
    present = lowered.contains(needle)
    if " " not in needle and "-" not in needle:
        # The cheap byte search short-circuits the regex for most rows.
        present = present & lowered.rlike(_search_pattern(needle))
    return F.coalesce(present, F.lit(False))


def _total(flags: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, [f.cast("int") for f in flags])


def keyword_score(lowered: Column, axes: Mapping[str, Sequence[str]]) -> Column:
    """Share of keywords hit (one axis) or of axes hit at least once (several).

    Blank keywords and empty axes never match but stay in the denominator.
    """
    if not axes:
        return F.lit(0.0)
    if len(axes) == 1:
        (keywords,) = axes.values()
        if not keywords:
            return F.lit(0.0)
        return _total([keyword_hit(lowered, k) for k in keywords]) / F.lit(float(len(keywords)))
    per_axis = [
        reduce(lambda a, b: a | b, [keyword_hit(lowered, k) for k in keywords], F.lit(False))
        for keywords in axes.values()
    ]
    return _total(per_axis) / F.lit(float(len(axes)))


def split_keywords(pasted: Column) -> Column:
    """Pasted text to trimmed, non-blank keywords in their original order."""
    pieces = F.transform(F.split(F.coalesce(pasted, F.lit("")), r"[\n,;]+"), strip)
    return F.filter(pieces, lambda k: k != "")


def ranked_keywords(keywords: Column) -> Column:
    """Keywords as (lower-cased key, position, value), ordered by key then position."""
    return F.array_sort(
        F.transform(
            keywords,
            lambda k, i: F.struct(F.lower(k).alias("key"), i.alias("pos"), k.alias("value")),
        )
    )


def first_spellings(ranked: Column) -> Column:
    """Keep the earliest spelling per key from a materialised ``ranked_keywords``.

    Sorting puts equal keys side by side, so a comparison with the neighbour is
    enough: O(n log n) inside the row, no explode and no shuffle.
    """
    shifted = F.concat(
        F.array(F.lit(None).cast("string")),
        F.transform(F.slice(ranked, F.lit(1), F.greatest(F.size(ranked) - 1, F.lit(0))), lambda r: r["key"]),
    )
    heads = F.zip_with(
        ranked,
        shifted,
        lambda r, before: F.when(
            r.isNotNull() & ~r["key"].eqNullSafe(before),
            F.struct(r["pos"].alias("pos"), r["value"].alias("value")),
        ),
    )
    kept = F.array_sort(F.filter(heads, lambda h: h.isNotNull()))
    return F.transform(kept, lambda h: h["value"])


def flatten_axes(axes: Column) -> Column:
    """All keywords of a topic in first-seen order without exact repeats."""
    return F.array_distinct(F.flatten(F.map_values(axes)))
