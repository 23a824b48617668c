"""Every fixed pattern means the same to the JVM engine as its plain spelling means here."""

import random
import re
import time

from pyspark.sql import functions as F

from benchbook.functions import citations, narrative, normalize, parties, quality
from benchbook.functions import fixed_values as V
from benchbook.functions.regex import (
    WHITESPACE,
    all_groups,
    before_first,
    collapse,
    folded,
    found,
    halves,
    holds_any,
    jvm,
    replace_all,
    strip,
    through_first,
)

FRAGMENTS = [
    " ", "  ", "\n", "\n\n", "\t", "\xa0", "\x1c", "\x0b", "\r\n", " ", ".", ",", "-", "/", ":",
    "(", ")", "[", "]", "&", ";", "*", "'", "–", "1", "12", "1950", "2024", "674", "A", "B", "b c",
    "in the supreme court of india", "IN THE", "SUPREME", "COURT OF INDIA", "Not Reportable",
    "REPORTABLE", "Civil Appeal", "writ petition", "(Civil)", "No.", "Nos.", "No(s).", "no", "of",
    "September", "sep", "Dec.", "may", "30", "JJ.", "JJ", "CJI", "C.J.", "CJ", "J.", "J", "and",
    "AND", "Kapur", "éclair", "Élan", "CORAM", "coram:", "Hon'ble", "Justice", "Dr.", "S.C.C.",
    "SCC", "AIR", "A.I.R.", "S.C.", "SCR", "S.C.R.", "Scrope", "INSC", "insc", "Section", "Sec.",
    "Article", "Order", "302,", "21A", "39(1)", "the", "I.P.C.", "IPC", "Cr.P.C.", "CPC",
    "Constitution of India", "constitution", "N.I. Act", "M.V.  Act", "Arbitration", "x Act",
    "Evidence Act", "In Re", "Re:", "SUO MOTU", "v.", "vs", "VERSUS", "v.p", "I'.",
    "Issue for consideration", "Headnotes", "HEADNOTE", "Summary", "JUDGMENT", "O R D E R",
    "J U D G M E N T", "For Appellant", "List of Keywords", "Case Arising From", "Held:", "HELD,",
    "held", "[Para 4]", "[Paras 1, 2]", "Result:", "label:", "Result of the", "Case", ": ",
    "appeal is allowed", "appeals are  dismissed", "partly allowed", "disposed of", "year=1999",
    "/1988/", "x", "word",
]
SEARCHED = {
    "BANNER": "i", "REPORTABLE": "i", "PAGE_NUMBER_LINE": "", "MARGIN_LETTER_LINE": "",
    "LONE_LETTERS": "", "EDGE_PUNCTUATION": "", "CASE_NUMBER": "i", "YEAR_WORD": "",
    "YEAR_IN_KEY": "", "BENCH_SQUARE": "i", "BENCH_ROUND": "i", "JUDGE_MARK": "i",
    "JUDGE_LIST_SIGN": "i", "CORAM": "is", "JUDGE_SEPARATOR": "i", "JUDGE_SUFFIX": "i",
    "JUDGE_HONORIFIC": "i", "PROVISION": "i", "PARTY_EDGES": "", "IN_RE_LINE": "i",
    "CASE_LINE": "i", "REPORT_HEADER_LINE": "i", "VERSUS_INLINE": "i", "SUMMARY_MARKER": "is",
    "SUMMARY_STOP": "i", "KEYWORD_SECTION": "is", "HEADNOTE_LINE": "i", "CATCHLINE": "",
    "HELD": "ims", "PARA_NOTE": "", "RESULT_LINE": "i",
}


def _flags(letters):
    return sum(getattr(re, letter.upper()) for letter in letters)


def _texts(count):
    pick = random.Random(11)
    return [
        "".join(
            pick.choice(FRAGMENTS) + pick.choice(["", " ", " ", "\n"])
            for _ in range(pick.randrange(1, 40))
        )
        for _ in range(count)
    ]


def _patterns():
    yield from ((name, getattr(V, name), flags) for name, flags in SEARCHED.items())
    yield from ((f"date{i}", p, "i") for i, p in enumerate(V.DATES))
    yield from ((f"cite_{kind}", p, "i") for kind, (p, _) in V.CITATIONS.items())
    yield from ((f"act{i}", p, "i") for i, (p, _) in enumerate(V.ACT_SHORT_NAMES))
    yield from ((f"party{i}", p, "i") for i, p in enumerate(V.PARTY_NOISE))
    yield from ((f"tail{i}", p, "i") for i, (_, p, _) in enumerate(V.RESULT_TAIL))


def test_patterns_agree(spark):
    texts = _texts(1500)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string").repartition(4)
    patterns = list(_patterns())
    columns = []
    for name, pattern, flags in patterns:
        groups = min(re.compile(pattern).groups, 1)
        columns.append(all_groups(F.col("x"), pattern, groups, flags).alias(f"{name}_all"))
        columns.append(replace_all(F.col("x"), pattern, "<>", flags).alias(f"{name}_to"))
        columns.append(halves(F.col("x"), pattern, flags)[0].alias(f"{name}_half"))
    for row in df.select("i", *columns).collect():
        text = texts[row["i"]]
        for name, pattern, flags in patterns:
            compiled = re.compile(pattern, _flags(flags))
            hits = list(compiled.finditer(text))
            group = min(compiled.groups, 1)
            assert row[f"{name}_all"] == [h.group(group) or "" for h in hits], (name, text)
            assert row[f"{name}_to"] == compiled.sub("<>", text), (name, text)
            if hits and hits[0].end() > hits[0].start():
                assert row[f"{name}_half"] == text[: hits[0].start()], (name, text)


def test_starts_lose_no_match(spark):
    """The look-aheads put before some patterns accept every place where a match begins."""
    texts = _texts(1500)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    pairs = [(V.CASE_NUMBER_START, V.CASE_NUMBER), (V.SUMMARY_STOP_START, V.SUMMARY_STOP)]
    pairs += list(zip(V.DATE_STARTS, V.DATES))
    pairs += [(V.CITATION_STARTS[kind], p) for kind, (p, _) in V.CITATIONS.items()]
    pairs += [(f"(?={words[0]})", f"(?:{p})") for words, p, _ in V.RESULT_TAIL]
    pairs += [(V.PROVISION_START, V.PROVISION)]
    same = [
        all_groups(F.col("x"), start + p, 0, "i") == all_groups(F.col("x"), p, 0, "i")
        for start, p in pairs
    ]
    assert df.filter(~F.forall(F.array(*same), lambda ok: ok)).count() == 0
    words = {**{k: (p, V.CITATION_WORDS[k]) for k, (p, _) in V.CITATIONS.items()},
             "held": (V.HELD, V.HELD_WORDS), "kw": (V.KEYWORD_SECTION, V.KEYWORD_WORDS),
             "hn": (V.HEADNOTE_LINE, V.HEADNOTE_WORDS)}
    low = folded(F.lower("x"))
    missed = [found(F.col("x"), p, "ims") & ~holds_any(low, w) for p, w in words.values()]
    assert df.filter(F.exists(F.array(*missed), lambda bad: bad)).count() == 0


BLANKS = ["\n", "\n", "\n", " ", "  ", "\n ", "12", "7", "123456", "a", "-", "Held:", "Held, ", "Ab:", "held: x"]


def test_blank_runs(spark):
    """Trying only the first line break of a blank run changes nothing."""
    pick = random.Random(3)
    texts = ["".join(pick.choices(BLANKS, k=pick.randrange(1, 30))) for _ in range(4000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    page = replace_all(F.col("x"), V.PAGE_NUMBER_START + V.PAGE_NUMBER_LINE, "\n")
    held = all_groups(F.col("x"), V.HELD_START + V.HELD, 1, "ims")
    plain_held = re.compile(V.HELD, _flags("ims"))
    for i, a, b in df.select("i", page, held).collect():
        assert a == re.sub(V.PAGE_NUMBER_LINE, "\n", texts[i]), texts[i]
        assert b == [m.group(1) for m in plain_held.finditer(texts[i])], texts[i]


def test_long_runs_take_linear_time(spark):
    """A text of nothing but blank lines, letters or hyphens must not hold up a task."""
    n = 300_000
    texts = ["\n" * n + "x", "\n " * n + "held", "a " * n + "held", "-" * n + "held", "x" * n]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(5)
    low = folded(F.lower("t"))
    start = time.time()
    df.select(
        normalize.clean_text(F.col("t")), narrative.holding(F.col("t"), low),
        citations.cases_cited(F.col("t"), low), citations.acts_cited(F.col("t"), low),
        quality.quality_score(F.col("t"), F.lower("t")), narrative.tags_from_keywords(F.col("t"), low),
    ).write.format("noop").mode("overwrite").save()
    assert time.time() - start < 60


def test_white_space(values):
    every = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    assert sorted(WHITESPACE) == every
    texts = [f"{c} a{c}{c}b {c}" for c in every] + _texts(300)
    assert values(strip, texts) == [t.strip() for t in texts]
    assert values(collapse, texts) == [" ".join(t.split()) for t in texts]


def test_blank_runs_longer_than_the_look_behind(spark):
    """The look-behind of 99 characters bounds the cost only: longer runs give the same results."""
    pick = random.Random(4)
    texts = []
    for _ in range(300):
        run = lambda: "".join(pick.choices("\n\n \t", k=pick.choice([98, 99, 100, 101, 250, 1000])))
        parts = pick.choices(["12", "7", "Held: so it was decided.", "- Held, more of it", "Ab: x", "a"], k=4)
        texts.append(run().join(parts))
    df = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    page = replace_all(F.col("x"), V.PAGE_NUMBER_START + V.PAGE_NUMBER_LINE, "\n")
    held = all_groups(F.col("x"), V.HELD_START + V.HELD, 1, "ims")
    plain = re.compile(V.HELD, _flags("ims"))
    for i, a, b in df.select("i", page, held).collect():
        assert a == re.sub(V.PAGE_NUMBER_LINE, "\n", texts[i])
        assert b == [m.group(1) for m in plain.finditer(texts[i])]


def _same(df, pairs):
    """Rows where both columns of a pair differ, for each pair."""
    return [df.filter(~a.eqNullSafe(b)).count() for a, b in pairs]


def test_fast_forms_find_the_same(spark):
    pick = random.Random(21)
    extra = ["not", "NOT ", "rep", "reportable", "Not  Reportable", "a", "A.", "I", "R", "0", "2", "4567", "/", "-",
             "\u017fec", "Sec", "Art. ", "Rule 3 ", "order 1", "Held :", "\n", "\n\n", "\nAb:", "- held, x",
             "\u0130", "\u0131n", "\U0001d7ce", "\u0660"]
    texts = _texts(1200) + ["".join(pick.choices(extra + FRAGMENTS, k=pick.randrange(1, 40))) for _ in range(4000)]
    texts += ["".join(pick.choices(BLANKS + ["\n" * 120], k=pick.randrange(1, 20))) for _ in range(2000)] + [""]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "x string").repartition(8).cache()
    x = F.col("x")
    pairs = [(replace_all(x, V.REPORTABLE_FAST, "<>", "i"), replace_all(x, V.REPORTABLE, "<>", "i"))]
    for fast, plain in zip(V.DATES_FAST, V.DATES):
        pairs.append((all_groups(x, fast, 0, "i"), all_groups(x, plain, 0, "i")))
    for kind, (plain, _) in V.CITATIONS.items():
        pairs.append((all_groups(x, V.CITATIONS_FAST[kind], 0, "i"), all_groups(x, plain, 0, "i")))
    pairs.append((all_groups(x, V.PROVISION_FAST, 0, "i"), all_groups(x, V.PROVISION, 0, "i")))
    held = all_groups(F.concat(F.lit("\n"), x), V.HELD_FAST, 1, "is")
    pairs.append((held, all_groups(x, V.HELD, 1, "ims")))
    marker = V.SUMMARY_MARKER_START + V.SUMMARY_MARKER
    pairs.append((all_groups(x, marker, 1, "is"), all_groups(x, V.SUMMARY_MARKER, 1, "is")))
    for pattern in (V.BENCH_SQUARE, V.BENCH_ROUND, V.SUMMARY_STOP):
        parts = halves(x, pattern, "i")
        cut = F.size(parts) == 2
        through = F.when(cut, F.substring(x, F.lit(1), F.length(x) - F.length(F.get(parts, 1)))).otherwise("")
        pairs.append((through_first(x, pattern, "i"), F.when(x.isNotNull(), through)))
        before = F.when(cut, F.get(parts, 0)).otherwise("")
        pairs.append((before_first(x, pattern, "i"), F.when(x.isNotNull(), before)))
    plain_collapse = strip(F.regexp_replace(x, F.lit(jvm(r"\s+")), F.lit(" ")))
    pairs.append((collapse(x), plain_collapse))
    low = F.lower(x)
    for special, plain in (("\u017f", "s"), ("\u0131", "i"), ("i\u0307", "i")):
        low = F.replace(low, F.lit(special), F.lit(plain))
    pairs.append((folded(F.lower(x)), low))
    assert _same(df, pairs) == [0] * len(pairs)


def test_searches_begin_with_a_class(spark):
    """Held passages are found in a fraction of the time that a choice at every position takes."""
    text = ("the tribunal restored an order on the appeal of a tenant-at-will " * 15 + "\n") * 30
    df = spark.createDataFrame([(text + "Held: that it stands.",)] * 8, "t string").repartition(8)
    many = df.crossJoin(spark.range(60)).select(F.concat("t", F.col("id").cast("string")).alias("t"))
    forms = {
        "plain": all_groups(F.col("t"), V.HELD_START + V.HELD, 1, "ims"),
        "fast": all_groups(F.concat(F.lit("\n"), "t"), V.HELD_FAST, 1, "is"),
    }
    taken = {}
    for _ in range(3):  # the first runs compile
        for name, found_in in forms.items():
            start = time.time()
            many.select(found_in.alias("x")).write.format("noop").mode("overwrite").save()
            taken[name] = min(time.time() - start, taken.get(name, 1e9))
    assert taken["fast"] < 0.7 * taken["plain"], taken


def test_heavy_inputs_are_named_once(spark):
    """Strategies that look at the same lines share them: each would cut the window anew."""
    sides = parties.sides(normalize.header_lines(F.col("x")))
    df = spark.createDataFrame([("a v. b",)], "x string").select(sides.alias("s"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[A-H]") == 1
    block = parties.title_block(normalize.header_lines(F.col("x")))
    df = spark.createDataFrame([("a v. b",)], "x string").select(block.alias("s"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("[A-H]") == 1


def test_page_numbers_party_noise_and_marks_in_fast_forms(spark):
    """Class-first forms and guards of headers find what the plain patterns find."""
    pick = random.Random(31)
    extra = ["S", "s.", "C", "R.", "\u017f.C.R. 7", "Scr", "j", "cj", "c.j", "C.J.", "cc", "jj", "I'", "v", "V.", "\u0130",
             "vs.", "i'.", "*v.", "..v..", "Auguſt 3, 1999", "\u017fep 4 1988", "mayx 1,2000", "JUNE-12-2001", "dec"]
    texts = _texts(800) + ["".join(pick.choices(extra + FRAGMENTS, k=pick.randrange(1, 25))) for _ in range(3000)]
    texts += ["".join(pick.choices(BLANKS, k=pick.randrange(1, 20))) for _ in range(1500)]
    texts += [pick.choice(extra) + pick.choice(["", ".", "'", "'.", ".p", ",", " "]) for _ in range(300)] + [""]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "x string").repartition(8).cache()
    x = F.col("x")
    pairs = [(replace_all(x, V.PAGE_NUMBER_FAST, "\n"), replace_all(x, V.PAGE_NUMBER_LINE, "\n"))]
    for fast, plain in zip(V.PARTY_NOISE_FAST, V.PARTY_NOISE):
        pairs.append((replace_all(x, fast, "<>", "i"), replace_all(x, plain, "<>", "i")))
    pairs.append((found(x, V.JUDGE_MARK_FAST), found(x, V.JUDGE_MARK, "i")))
    pairs.append((parties._is_versus(x), normalize.edge_word(x).isin(*V.VERSUS) | x.isin(*V.VERSUS_LINES)))
    pairs.append((all_groups(x, V.DATES_FAST[1], 0, "i"), all_groups(x, V.DATES[1], 0, "i")))
    assert _same(df, pairs) == [0] * len(pairs)
