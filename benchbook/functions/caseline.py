"""Case number, judgment date and year, read from the collapsed header."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from benchbook.functions import fixed_values as V
from benchbook.functions.regex import collapse, first_group, jvm, let, strip


def _digits(c: Column) -> Column:
    return c.try_cast("int")


def case_line(header: Column) -> Column:
    """Struct of ``case_type, case_number, case_year``; NULL without a case line."""

    def parts(hit: Column) -> Column:
        group = lambda g: F.regexp_extract(hit, jvm(V.CASE_NUMBER, "i"), g)
        kind = F.initcap(strip(group(1)))
        number = F.concat(kind, F.lit(" No. "), collapse(group(2)), F.lit(" of "), group(3))
        return F.when(
            hit != "",
            F.struct(
                kind.alias("case_type"),
                number.alias("case_number"),
                _digits(group(3)).alias("case_year"),
            ),
        )

    return let(
        F.regexp_extract(header, jvm(V.CASE_NUMBER_START + V.CASE_NUMBER, "i"), 0), parts
    )


def judgment_date(header: Column) -> Column:
    """Date text as found; the first pattern that occurs anywhere wins."""
    return strip(
        F.coalesce(
            *[first_group(header, pattern, 0, "i") for pattern in V.DATES_FAST]
        )
    )


def resolved_year(date: Column, key: Column, case_year: Column) -> Column:
    """Year of the date, else of the key, else of the case line."""
    of_date = _digits(first_group(date, V.YEAR_WORD))
    of_key = _digits(F.regexp_extract(F.regexp_extract(key, jvm(V.YEAR_IN_KEY), 0), r"\d{4}", 0))
    return F.coalesce(F.nullif(of_date, F.lit(0)), F.nullif(of_key, F.lit(0)), case_year)
