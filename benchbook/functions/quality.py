"""Word count, letter share, legal vocabulary, quality score and content hash."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from benchbook.functions import fixed_values as V
from benchbook.functions.regex import found, jvm, let

_SCALE = 1 << 62


def word_count(text: Column) -> Column:
    """White-space separated words, without building an array of them."""
    marked = F.regexp_replace(text, F.lit(jvm(r"[^\s]+")), F.lit("x"))
    return F.length(F.regexp_replace(marked, F.lit("[^x]+"), F.lit("")))


def has_min_words(text: Column) -> Column:
    """At least ``MIN_WORDS`` words; reads no further than that many words."""
    return found(text, rf"\A\s*+(?:[^\s]++\s++){{{V.MIN_WORDS - 1}}}+[^\s]")


def alpha_ratio(text: Column) -> Column:
    others = F.length(F.regexp_replace(text, F.lit(r"\p{L}++"), F.lit("")))
    return let(F.length(text), lambda size: (size - others) / F.greatest(size, F.lit(1)))


def legal_word_hits(lower: Column) -> Column:
    """How many of the legal words occur in a lower-cased text."""
    return reduce(
        lambda a, b: a + b, [F.contains(lower, F.lit(w)).cast("int") for w in V.LEGAL_WORDS]
    )


def round3(x: Column) -> Column:
    """Round a double in [0, 1] to 3 places by its exact binary value, ties to even.

    ``x * 2**62`` is a whole number for every double from 2**-10 up, so the distance to the
    lower thousandth is known exactly.
    """
    unit = F.lit(_SCALE).cast("decimal(20,0)")
    exact = F.ceil(x * F.lit(float(_SCALE))).cast("decimal(20,0)")
    whole = F.floor(x * 1000.0)
    rest = exact * F.lit(1000).cast("decimal(4,0)") - whole.cast("decimal(10,0)") * unit
    twice = rest * F.lit(2).cast("decimal(1,0)")
    up = (twice > unit) | ((twice == unit) & (whole % 2 == 1))
    return (whole + up.cast("int")).cast("double") / 1000.0


def quality_score(text: Column, lower: Column) -> Column:
    """Score from a text and its lower-cased form; short texts score 0."""
    raw = alpha_ratio(text) * 0.5 + (legal_word_hits(lower) / F.lit(10)) * 0.5
    return F.when(has_min_words(text), let(raw, round3)).otherwise(F.lit(0.0))


def content_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def passes_gate(score: Column) -> Column:
    return score >= V.MIN_QUALITY
