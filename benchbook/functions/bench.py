"""The judges' bench: where it stands in the header and who sits on it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from benchbook.functions import fixed_values as V
from benchbook.functions.normalize import head
from benchbook.functions.regex import (
    all_groups,
    collapse,
    found,
    jvm,
    let,
    replace_all,
    strip,
    through_first,
)


def _closed_block(window: Column, pattern: str, closer: str) -> Column:
    def span(through: Column) -> Column:
        return F.when(
            through != "",
            F.struct(
                strip(F.regexp_extract(through, jvm(pattern, "i"), 1)).alias("raw"),
                F.length(through).alias("end"),
            ),
        )

    return let(
        F.when(F.contains(window, F.lit(closer)), through_first(window, pattern, "i")), span
    )


def _damaged_block(window: Column) -> Column:
    """First opening bracket before a capital whose next 400 characters (up to a blank line)
    hold a judge mark with a list sign before it; the span runs to the last such mark."""

    def span(rest: Column, block: Column) -> Column:
        def cut(after: Column) -> Column:
            stop = F.length(block) - F.length(after)
            mark = F.element_at(all_groups(block, V.JUDGE_MARK, flags="i"), -1)
            listed = F.substring(block, F.lit(1), stop - F.length(mark))
            return F.when(
                (stop > 0) & found(listed, V.JUDGE_LIST_SIGN, "i"),
                F.struct(
                    strip(F.substring(block, F.lit(1), stop)).alias("raw"),
                    (F.length(window) - F.length(rest) + stop).alias("end"),
                ),
            )

        # a split compiles its pattern anew for every block, so only blocks with a mark are split
        pieces = F.split(block, jvm(V.JUDGE_MARK, "i"), -1)
        return F.when(found(block, V.JUDGE_MARK_FAST), let(F.element_at(pieces, -1), cut))

    rests = all_groups(window, r"[\[\(]\s*(?=([A-Z].*))", 1, "s")
    spans = F.transform(
        rests,
        lambda rest: let(
            F.substring_index(head(rest, V.AFTER_BENCH_CHARS), "\n\n", 1),
            lambda block: span(rest, block),
        ),
    )
    return F.get(F.filter(spans, lambda s: s.isNotNull()), F.lit(0))


def bench_span(text: Column) -> Column:
    """Struct of the raw bench text and the offset where it ends; NULL if there is none."""
    return let(
        head(text, V.BENCH_CHARS),
        lambda window: F.coalesce(
            _closed_block(window, V.BENCH_SQUARE, "]"),
            _closed_block(window, V.BENCH_ROUND, ")"),
            _damaged_block(window),
        ),
    )


def _is_judge(name: Column) -> Column:
    return (F.length(name) > V.JUDGE_NAME_MIN) & ~let(
        F.lower(name),
        lambda low: F.exists(
            F.array(*[F.lit(w) for w in V.NOT_A_JUDGE]), lambda w: F.contains(low, w)
        ),
    )


def _judge_name(segment: Column) -> Column:
    name = replace_all(strip(segment), V.JUDGE_SUFFIX, flags="i")
    name = replace_all(name, V.JUDGE_HONORIFIC, flags="i")
    name = F.replace(name, F.lit("*"), F.lit(""))
    return collapse(replace_all(name, V.EDGE_PUNCTUATION))


def judge_names(raw: Column) -> Column:
    """Names in a raw bench text, in order, repeats kept; empty for NULL."""
    spaced = replace_all(F.coalesce(raw, F.lit("")), r"\s+", " ")
    names = F.transform(F.split(spaced, jvm(V.JUDGE_SEPARATOR, "i"), -1), _judge_name)
    return F.filter(names, _is_judge)


def coram_names(text: Column) -> Column:
    """Names in the paragraph after the word CORAM, if that is short enough."""
    block = strip(F.regexp_extract(head(text, V.BENCH_CHARS), jvm(V.CORAM, "is"), 1))
    return let(
        block, lambda raw: judge_names(F.when(F.length(raw) < V.CORAM_MAX, raw))
    )


def bench_names(text: Column, span: Column) -> Column:
    return let(
        judge_names(span["raw"]),
        lambda names: F.when(F.size(names) > 0, names).otherwise(coram_names(text)),
    )


def applicability(bench: Column) -> Column:
    return F.when(
        F.exists(bench, lambda name: F.contains(name, F.lit(V.FULL_BENCH_NAME))),
        F.lit(V.FULL_BENCH_SENTENCE),
    ).when(F.size(bench) > 0, F.format_string(V.BENCH_SENTENCE, F.size(bench)))
