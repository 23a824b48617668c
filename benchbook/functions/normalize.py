"""Text normalisation: document clean-up, party names, statute names, windows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from benchbook.functions import fixed_values as V
from benchbook.functions.regex import collapse, holds_any, let, replace_all, strip


def _replace_if(c: Column, signs: tuple[str, ...], pattern: str, to: str) -> Column:
    """Replace only in texts that hold one of the signs a match needs."""
    return let(
        c, lambda t: F.when(holds_any(t, signs), replace_all(t, pattern, to)).otherwise(t)
    )


def clean_text(c: Column) -> Column:
    """Drop banner, report marks and page-number lines, then settle blank space."""
    c = replace_all(c, V.BANNER, flags="i")
    c = replace_all(c, V.REPORTABLE_FAST, flags="i")
    c = replace_all(c, V.PAGE_NUMBER_FAST, "\n")
    c = _replace_if(c, ("\n\n\n",), r"\n{3,}", "\n\n")
    c = _replace_if(c, ("  ", "\t"), r"[ \t]{2,}", " ")
    c = _replace_if(c, ("\x0c", "\x0b"), r"[\x0c\x0b]", "\n\n")
    return strip(c)


def drop_margin_letters(c: Column) -> Column:
    return replace_all(c, V.MARGIN_LETTER_LINE, "\n")


def strip_lone_letters(c: Column) -> Column:
    # possessive, so that long letter runs need no backtracking stack
    return strip(replace_all(c, V.LONE_LETTERS + "+"))


def clean_party_name(c: Column) -> Column:
    c = strip_lone_letters(F.coalesce(c, F.lit("")))
    for noise in V.PARTY_NOISE_FAST:
        c = strip(replace_all(c, noise, flags="i"))
    return collapse(replace_all(c, V.PARTY_EDGES))


def canonical_act_name(c: Column) -> Column:
    c = replace_all(c, r"\s+", " ")
    for pattern, short in V.ACT_SHORT_NAMES:
        c = replace_all(c, pattern, short, flags="i")
    return strip(c)


def edge_word(c: Column) -> Column:
    """Lower-cased text without punctuation at its ends."""
    return F.lower(strip(replace_all(c, V.EDGE_PUNCTUATION)))


def head(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def collapsed_header(text: Column) -> Column:
    return collapse(head(text, V.HEADER_CHARS))


def header_lines(text: Column) -> Column:
    """Non-empty stripped lines of the title window, margin letters removed."""
    return let(
        drop_margin_letters(head(text, V.TITLE_CHARS)),
        lambda t: F.filter(F.transform(F.split(t, "\n"), strip), lambda line: line != ""),
    )
