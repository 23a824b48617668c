"""Petitioner, respondent and title, read from the first lines of a judgment.

Each strategy gives the raw names it finds, or NULL where it does not apply.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from benchbook.functions import fixed_values as V
from benchbook.functions.normalize import clean_party_name, edge_word, head
from benchbook.functions.regex import collapse, first_where, found, halves, let


def _sides(petitioner: Column, respondent: Column) -> Column:
    return F.struct(petitioner.alias("petitioner"), respondent.alias("respondent"))


def cleaned(sides: Column) -> Column:
    """Both names of a pair of sides cleaned; NULL stays NULL."""
    return let(
        sides,
        lambda s: F.when(
            s.isNotNull(),
            _sides(clean_party_name(s["petitioner"]), clean_party_name(s["respondent"])),
        ),
    )


def _is_versus(line: Column) -> Column:
    word = found(line, V.VERSUS_START) & edge_word(line).isin(*V.VERSUS)
    return word | line.isin(*V.VERSUS_LINES)


def in_re(lines: Column) -> Column:
    """Sides of an "In Re" or "Suo Motu" matter among the first lines, else NULL."""

    def sides(line: Column) -> Column:
        subject = F.coalesce(F.get(halves(line, r"[:\-]"), F.lit(1)), line)
        return F.when(line.isNotNull(), _sides(F.lit(V.IN_RE_NAME), subject))

    candidates = F.filter(
        F.slice(lines, 1, V.IN_RE_LINES), lambda line: found(line, V.IN_RE_LINE, "i")
    )
    return let(collapse(F.get(candidates, F.lit(0))), sides)


def title_block(lines: Column) -> Column:
    """Lines above the case-number line (or the first few), without margin residue."""
    return let(lines, _title_block)


def _title_block(lines: Column) -> Column:
    block = let(
        first_where(
            F.slice(lines, 1, V.CASE_LINE_LINES), lambda line: found(line, V.CASE_LINE, "i")
        ),
        lambda at: F.when(at > 0, F.slice(lines, F.lit(1), (at - 1).cast("int"))).otherwise(
            F.slice(lines, 1, V.TITLE_LINES)
        ),
    )

    def kept(line: Column) -> Column:
        residue = (F.length(line) <= V.SHORT_LINE) & ~_is_versus(line)
        return ~(found(line, V.REPORT_HEADER_LINE, "i") | found(line, r"^\d+$") | residue)

    return F.filter(block, kept)


def versus_line(block: Column) -> Column:
    """Sides around a line that is nothing but a versus mark, else NULL."""

    def sides(at: Column) -> Column:
        before = F.slice(block, F.lit(1), (at - 1).cast("int"))
        after = F.slice(block, (at + 1).cast("int"), F.size(block))
        return F.when(at > 0, _sides(F.array_join(before, " "), F.array_join(after, " ")))

    return let(first_where(block, _is_versus), sides)


def versus_inline(block: Column) -> Column:
    """Sides around the first versus mark inside the joined block, else NULL."""
    return let(
        halves(F.array_join(block, " "), V.VERSUS_INLINE, "i"),
        lambda parts: F.when(
            F.size(parts) == 2, _sides(F.get(parts, F.lit(0)), F.get(parts, F.lit(1)))
        ),
    )


def outer_lines(block: Column) -> Column:
    """First and last line as the sides, given two lines or more, else NULL."""
    return F.when(F.size(block) >= 2, _sides(F.get(block, F.lit(0)), F.element_at(block, -1)))


def sides(lines: Column) -> Column:
    """The strategies above, in order of trust; the names are cleaned once, at the end.

    A strategy that applies decides, even if nothing is left of its names.
    """

    def by_trust(lines: Column) -> Column:
        return F.coalesce(
            in_re(lines),
            let(
                _title_block(lines),
                lambda block: F.coalesce(
                    versus_line(block), versus_inline(block), outer_lines(block)
                ),
            ),
        )

    # several strategies look at the lines, which are cut once
    return cleaned(let(lines, by_trust))


def petitioner(sides: Column) -> Column:
    return F.nullif(head(sides["petitioner"], V.PARTY_MAX), F.lit(""))


def respondent(sides: Column) -> Column:
    return F.when(
        sides["petitioner"] != "", F.nullif(head(sides["respondent"], V.PARTY_MAX), F.lit(""))
    )


def title(sides: Column) -> Column:
    whole = F.concat(sides["petitioner"], F.lit(" v. "), sides["respondent"])
    return F.when(sides["petitioner"] != "", head(whole, V.TITLE_MAX))


