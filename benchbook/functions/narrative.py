"""Summary, tags, holding and result of a judgment.

``low`` is the ``regex.folded`` text, made once for all fields.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from benchbook.functions import fixed_values as V
from benchbook.functions.normalize import drop_margin_letters, head, strip_lone_letters
from benchbook.functions.regex import (
    all_groups,
    before_first,
    collapse,
    folded,
    found,
    holds_all,
    holds_any,
    jvm,
    let,
    replace_all,
    strip,
)


def _no_tags() -> Column:
    return F.array().cast("array<string>")


def _after(text: Column, offset: Column, length: int) -> Column:
    return F.substring(text, offset + 1, F.lit(length))


# ---- summary -------------------------------------------------------------------------


def summary_from_marker(text: Column, low: Column) -> Column:
    """Text after an issue/headnote/summary marker in the header, if long enough."""
    marked = F.when(
        holds_any(low, V.SUMMARY_WORDS),
        F.regexp_extract(head(text, V.HEADER_CHARS), jvm(V.SUMMARY_MARKER_START + V.SUMMARY_MARKER, "is"), 1),
    )
    return let(
        drop_margin_letters(strip(marked)),
        lambda s: F.when(F.length(s) > V.SUMMARY_MARKER_MIN, head(s, V.SUMMARY_MAX)),
    )


def summary_after_bench(text: Column, bench_end: Column) -> Column:
    """Header text between the bench and the first stop phrase, if long enough."""

    rest = _after(head(text, V.HEADER_CHARS), bench_end, V.HEADER_CHARS)
    block = before_first(rest, V.SUMMARY_STOP_START + V.SUMMARY_STOP, "i")
    return let(
        collapse(drop_margin_letters(strip(block))),
        lambda s: F.when(
            F.length(s) > V.SUMMARY_POST_BENCH_MIN, head(strip_lone_letters(s), V.SUMMARY_MAX)
        ),
    )


def summary(text: Column, low: Column, bench_end: Column) -> Column:
    return F.coalesce(summary_from_marker(text, low), summary_after_bench(text, bench_end))


# ---- tags ----------------------------------------------------------------------------


def tags_from_keywords(text: Column, low: Column) -> Column:
    """Tags of the keyword section; NULL without one, empty if it holds nothing."""

    def split(section: Column) -> Column:
        words = F.transform(
            F.split(F.regexp_extract(section, jvm(V.KEYWORD_SECTION, "is"), 1), ";"), collapse
        )
        return F.when(section != "", F.filter(words, lambda w: w != ""))

    section = F.regexp_extract(text, jvm(V.KEYWORD_SECTION, "is"), 0)
    return let(F.when(holds_any(low, V.KEYWORD_WORDS), section), split)


def tags_from_headnote(text: Column, low: Column) -> Column:
    """The one tag between a headnotes line and the first en dash; empty if there is none."""
    tag = collapse(F.regexp_extract(text, jvm(V.HEADNOTE_LINE, "i"), 1))
    return F.filter(
        F.array(F.when(holds_any(low, V.HEADNOTE_WORDS), tag)), lambda t: t != ""
    )


def tags_from_catchline(text: Column, bench_end: Column) -> Column:
    """Hyphen-separated subjects of the first sentence after the bench; empty if unfit."""
    shortest, longest = V.CATCHLINE_LENGTH
    fewest, most = V.CATCHLINE_TAGS

    def split(line: Column) -> Column:
        tags = F.filter(
            F.transform(F.split(line, "-"), lambda t: F.btrim(t, F.lit(" ."))),
            lambda t: t != "",
        )
        fit = (F.length(line) > shortest) & (F.length(line) < longest) & F.contains(line, F.lit("-"))
        return let(
            F.when(fit, tags),
            lambda t: F.when(F.size(t).between(fewest, most), t).otherwise(_no_tags()),
        )

    block = collapse(_after(text, bench_end, V.AFTER_BENCH_CHARS))
    return let(F.regexp_extract(block, jvm(V.CATCHLINE), 1), split)


def tags(text: Column, low: Column, bench_end: Column) -> Column:
    def without_section(headnote: Column) -> Column:
        return F.when(F.size(headnote) > 0, headnote).otherwise(
            F.coalesce(tags_from_catchline(text, bench_end), _no_tags())
        )

    return F.coalesce(
        tags_from_keywords(text, low), let(tags_from_headnote(text, low), without_section)
    )


# ---- holding -------------------------------------------------------------------------


def holding(text: Column, low: Column) -> Column:
    """All held passages over the whole text, joined by blank lines; NULL if none."""
    passages = F.filter(
        F.transform(
            F.when(
                holds_any(low, V.HELD_WORDS) & found(low, V.HELD_SIGN),
                all_groups(F.concat(F.lit("\n"), text), V.HELD_FAST, 1, "is"),
            ),
            strip,
        ),
        lambda p: F.length(p) > V.HELD_MIN,
    )
    return let(
        F.transform(passages, lambda p: strip(replace_all(p, V.PARA_NOTE))),
        lambda kept: F.when(F.size(kept) > 0, F.array_join(kept, "\n\n")),
    )


# ---- result --------------------------------------------------------------------------


def _first_label(cases: list[tuple[Column, str]]) -> Column:
    return reduce(lambda chain, case: chain.when(case[0], case[1]), cases, F)


def result_from_line(text: Column, low: Column) -> Column:
    """Result named after the first "Result of the Case", NULL if unknown."""
    return let(
        F.when(
            holds_any(low, V.RESULT_LINE_WORDS),
            F.lower(F.regexp_extract(text, jvm(V.RESULT_LINE, "i"), 1)),
        ),
        lambda line: _first_label([(F.contains(line, F.lit(w)), r) for w, r in V.RESULT_WORDS]),
    )


def result_from_tail(text: Column) -> Column:
    """Result told by the closing characters of the text."""

    def told(tail: Column, low: Column) -> Column:
        return _first_label(
            [
                (
                    holds_all(low, words) & found(tail, f"(?={words[0]})(?:{pattern})", "i"),
                    label,
                )
                for words, pattern, label in V.RESULT_TAIL
            ]
        ).otherwise(V.RESULT_UNKNOWN)

    return let(
        F.right(text, F.lit(V.TAIL_CHARS)),
        lambda tail: let(folded(F.lower(tail)), lambda low: told(tail, low)),
    )


def result(text: Column, low: Column) -> Column:
    return F.coalesce(result_from_line(text, low), result_from_tail(text))
