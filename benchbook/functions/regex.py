"""Regular-expression and string helpers shared by all column functions.

Plain ``\\s`` and ``strip`` are meant in the Unicode sense here: besides Unicode white space
they cover the separators U+001C..U+001F, ``.`` stops only at a newline, and ``\\Z`` is the
absolute end of the text.  ``jvm`` adds exactly that to a pattern.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_SEPARATORS = r"\x1C-\x1F"
WHITESPACE = "".join(
    chr(c)
    for c in (
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    )
)


def jvm(pattern: str, flags: str = "") -> str:
    """Spell a plain pattern for ``java.util.regex`` (flags: i, m, s)."""
    out, in_class, i = [], False, 0
    while i < len(pattern):
        pair = pattern[i : i + 2]
        if pair == r"\s":
            out.append(rf"\s{_SEPARATORS}" if in_class else rf"[\s{_SEPARATORS}]")
        elif pair == r"\Z":
            out.append(r"\z")
        elif pair[0] == "\\":
            out.append(pair)
        else:
            in_class = pair[0] == "[" or (in_class and pair[0] != "]")
            out.append(pair[0])
            i += 1
            continue
        i += 2
    return f"(?dU{flags})" + "".join(out)


# a run of white space that is not already one plain space; the class turns printable ASCII down at
# once, the first look-ahead a space before it
_SPACES = jvm(r"[[^!-~]&&[\s]](?:(?<! )|(?![!-~])(?=\s))\s*")


def strip(c: Column) -> Column:
    """Remove white space at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def collapse(c: Column) -> Column:
    """Every run of white space becomes one space; ends stripped."""
    return F.trim(F.regexp_replace(c, F.lit(_SPACES), F.lit(" ")))


def replace_all(c: Column, pattern: str, to: str = "", flags: str = "") -> Column:
    return F.regexp_replace(c, F.lit(jvm(pattern, flags)), F.lit(to))


def folded(lower: Column) -> Column:
    """Lower-cased text as case-insensitive patterns see it: long s and special i's included."""

    def plain(c: Column) -> Column:
        done = c
        for special, letter in (("\u017f", "s"), ("\u0131", "i"), ("i\u0307", "i")):
            done = F.replace(done, F.lit(special), F.lit(letter))
        # replacing compares at every byte, a search for a rare first byte does not
        return F.when(holds_any(c, ("\u017f", "\u0131", "\u0307")), done).otherwise(c)

    return let(lower, plain)


def holds_any(low: Column, words: tuple[str, ...]) -> Column:
    """Whether a folded text holds one of the words.

    A byte search that costs a fraction of a pattern search: patterns over whole texts run only
    where a word occurs that every match must contain.
    """
    return reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words])


def holds_all(low: Column, words: tuple[str, ...]) -> Column:
    """Whether a folded text holds all of the words."""
    return reduce(lambda a, b: a & b, [F.contains(low, F.lit(w)) for w in words])


def found(c: Column, pattern: str, flags: str = "") -> Column:
    return c.rlike(jvm(pattern, flags))


def first_group(c: Column, pattern: str, group: int = 1, flags: str = "") -> Column:
    """Group of the first match, NULL where nothing (or only an empty group) is found."""
    # nullif names its argument twice, which would search twice
    return let(
        F.regexp_extract(c, jvm(pattern, flags), group), lambda hit: F.nullif(hit, F.lit(""))
    )


def all_groups(c: Column, pattern: str, group: int = 0, flags: str = "") -> Column:
    return F.regexp_extract_all(c, F.lit(jvm(pattern, flags)), F.lit(group))


def halves(c: Column, pattern: str, flags: str = "") -> Column:
    """``[before, after]`` of the first match; one element where there is none."""
    return F.split(c, jvm(pattern, flags), 2)


def through_first(c: Column, pattern: str, flags: str = "") -> Column:
    """The text up to the end of the first match, empty where there is none.

    Unlike a split, whose pattern is compiled anew for every row.
    """
    return F.regexp_extract(c, jvm(r"(?s:\A.*?)" + pattern, flags), 0)


def before_first(c: Column, pattern: str, flags: str = "") -> Column:
    """The text before the first match, empty where there is none (or nothing before it)."""
    return F.regexp_extract(c, jvm(r"(?s:\A(.*?))" + pattern, flags), 1)


def first_where(items: Column, test: Callable[[Column], Column]) -> Column:
    """Position (from 1) of the first element that passes, 0 if none does."""
    return F.array_position(F.transform(items, test), F.lit(True))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)
