"""Cited cases and cited statutes, found over the whole text.

``low`` is the ``regex.folded`` text, made once for all fields.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from benchbook.functions import fixed_values as V
from benchbook.functions.normalize import canonical_act_name
from benchbook.functions.regex import all_groups, holds_any, jvm, replace_all, strip


def _sorted_set(items: Column) -> Column:
    return F.array_sort(F.array_distinct(items))


def _cites(text: Column, low: Column, kind: str) -> Column:
    # the long text is searched once; only the short hits are searched again for their parts
    pattern, form = V.CITATIONS[kind]
    hits = F.when(
        holds_any(low, V.CITATION_WORDS[kind]),
        all_groups(text, V.CITATIONS_FAST[kind], flags="i"),
    ).otherwise(F.array().cast("array<string>"))
    return F.transform(hits, lambda hit: replace_all(hit, pattern, form, "i"))


def cites_of_kind(text: Column, low: Column, kind: str) -> Column:
    """Canonical citations of one kind (scc, air, scr, insc), distinct and sorted."""
    return _sorted_set(_cites(text, low, kind))


def cases_cited(text: Column, low: Column) -> Column:
    return _sorted_set(F.concat(*[_cites(text, low, kind) for kind in V.CITATIONS]))


def _provision(hit: Column) -> Column:
    def part(group: int) -> Column:
        return strip(F.regexp_extract(hit, jvm(V.PROVISION, "i"), group))

    number = F.regexp_replace(part(2), F.lit(",+$"), F.lit(""))
    return F.concat(
        F.initcap(part(1)), F.lit(" "), number, F.lit(" of "), canonical_act_name(part(3))
    )


def acts_cited(text: Column, low: Column) -> Column:
    hits = F.when(
        holds_any(low, V.PROVISION_WORDS),
        all_groups(text, V.PROVISION_FAST, flags="i"),
    ).otherwise(F.array().cast("array<string>"))
    return _sorted_set(F.transform(hits, _provision))
