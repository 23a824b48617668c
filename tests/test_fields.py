"""Hand-checked inputs and results for each derived field."""

import pytest
from pyspark.sql import functions as F

from benchbook.functions import bench, caseline, citations, narrative, normalize, parties
from benchbook.functions.regex import folded


def _low(function):
    return lambda c: function(c, folded(F.lower(c)))


def check(values, function, cases, kind="string"):
    got = values(function, list(cases.keys() if isinstance(cases, dict) else [c[0] for c in cases]), kind)
    expected = list(cases.values()) if isinstance(cases, dict) else [c[1] for c in cases]
    assert got == expected


def test_clean_text(values):
    check(values, normalize.clean_text, {
        "In  the Supreme\nCourt of INDIA  X": "X",
        "NOT REPORTABLE\nA reportable B": "A B",
        "a\n1\n2\n3\nb": "a\n2\nb",
        "a\n12345\nb": "a\n12345\nb",
        "a\x0cb\x0bc": "a\n\nb\n\nc",
        "\xa0 a \x1c": "a",
        "a\n\n\n\nb \t c": "a\n\nb c",
        " \n\t": "",
    })


def test_party_name(values):
    check(values, normalize.clean_party_name, [
        (None, ""),
        ("a c e g Ram Lal", "Ram Lal"),
        ("A. B. Name", ". B. Name"),
        ("[2011] 7 S.C.R. 318 Hari", "Hari"),
        ("Mr. Scrope of X", "ope of X"),
        ("2022 INSC 56 Meera", "Meera"),
        ("CASE DETAILS Digital Supreme  Court Reports X Y", "X Y"),
        ("-- 'Ram'  (Dead) ;", "'Ram' (Dead)"),
    ])


def test_act_name(values):
    check(values, normalize.canonical_act_name, {
        "I.P.C": "IPC", "i.p.c.": "IPC.", "Cr.P.C": "CrPC", "code of criminal  procedure": "CrPC",
        "C.P.C": "CPC", "N.I.  Act": "Negotiable Instruments Act", "MV Act": "Motor Vehicles Act",
        "Constitution of India": "Constitution", "Indian Penal Code": "Indian Penal Code",
    })


def test_case_line(values):
    def shown(c):
        line = caseline.case_line(c)
        return F.concat_ws("|", line["case_type"], line["case_number"], line["case_year"])

    check(values, shown, {
        "x civil appeal no. 12 & 13-15 of 1999.":
            "Civil Appeal|Civil Appeal No. 12 & 13-15 of 1999|1999",
        "Writ Petition (Civil) Nos. 5 of 2001": "Writ Petition|Writ Petition No. 5 of 2001|2001",
        "SLP (Crl.) No(s). 55/A of 1987": "Slp|Slp No. 55/A of 1987|1987",
        "Appeal No. 7 decided": "",
    })


def test_judgment_date(values):
    check(values, caseline.judgment_date, {
        "on 03-11-1970 or September 3, 1971": "September 3, 1971",
        "September 3, 1971 then 4 Oct. 1972": "4 Oct. 1972",
        "1950. December 21": "1950. December 21",
        "at 1/2/1960 x": "1/2/1960",
        "May 4 only": None,
    })


def test_year(spark):
    rows = [
        ("30 September 1966", "data/pdf/year=1980/x.pdf", 1955, 1966),
        ("September 302024", "data/pdf/year=1980/x.pdf", 1955, 1980),
        (None, "a/1975/b.pdf", 1955, 1975),
        (None, "a.pdf", 1955, 1955),
        ("1 May 0000", "a.pdf", None, None),
    ]
    df = spark.createDataFrame(rows, "d string, k string, c int, expected int")
    got = df.select(caseline.resolved_year(df.d, df.k, df.c).alias("y"), "expected").collect()
    assert all(r.y == r.expected for r in got)


SPANS = [
    (
        "x [SABYASACHI MUKHARJI, CJ AND M.M. PUNCHHI, J.] rest",
        "SABYASACHI MUKHARJI, CJ AND M.M. PUNCHHI, J.", 48,
        ["SABYASACHI MUKHARJI", "M.M. PUNCHHI"],
    ),
    ("(A. Bhandari, J.) [C. Dhanuka,* JJ. ] x", "C. Dhanuka,* JJ.", 37, ["C. Dhanuka"]),
    ("[R. Kapur and S. Dass, JJ.J\n\nnext, JJ.", "R. Kapur and S. Dass, JJ.", 26, ["R. Kapur", "S. Dass"]),
    (
        "(Civil Appeal No. 1 of 2000)\n[R. Kapur, JJ.J",
        "Civil Appeal No. 1 of 2000)\n[R. Kapur, JJ.", 43, [],
    ),
    ("(M. Royal, CJI and J. C. Shah, CJJ", "M. Royal, CJI and J. C. Shah, CJ", 33, ["M. Royal", "J. C. Shah"]),
    ("(no capital, JJ x [Only JJ", None, None, []),
    ("é [Hon'ble Justice A. Roy, Bose; Courtney W & Dr. K. Rao, JJ.]", None, 62, ["Justice A. Roy", "K. Rao"]),
    ("x" * 2990 + " [R. Kapur, JJ.]", None, None, []),
]


def test_bench_span(values):
    spans = values(bench.bench_span, [s[0] for s in SPANS])
    for (text, raw, end, _), span in zip(SPANS, spans):
        assert (span.end if span else None) == end, text
        if raw is not None or span is None:
            assert (span.raw if span else None) == raw, text


def test_bench_names(values):
    names = values(lambda c: bench.bench_names(c, bench.bench_span(c)), [s[0] for s in SPANS])
    # the fourth block also holds the case number, which rules the name out
    assert names == [s[3] for s in SPANS]
    check(values, lambda c: bench.bench_names(c, bench.bench_span(c)), {
        "CORAM: Justice A. Kumar & Shri B. Rao\n\nx": ["A. Kumar", "B. Rao"],
        "[Held by the Court, JJ.] Coram - Mr. M. H. Beg": ["M. H. Beg"],
        "CORAM: " + "A. Kumar, " * 21: [],
    })


def test_applicability(values):
    check(values, bench.applicability, [
        (["A", "Constitution Bench X"],
         "Binding on all courts in India. Applied in all cases involving constitutional questions."),
        (["A", "B"], "Binding on all lower courts. Decided by 2-Judge Bench."),
        ([], None),
    ], "array<string>")


def test_citations(values):
    check(values, _low(citations.cases_cited), {
        "[1950] 4 S.C.R. 25; A.I.R. 1950 S.C. 7, (2024) 10 S.C.C. 126 and (2024) 10 scc 126, 2019 insc 7":
            ["(2024) 10 SCC 126", "2019 INSC 7", "AIR 1950 SC 7", "[1950] 4 SCR 25"],
        "(1994) 3 ſcc 1": ["(1994) 3 SCC 1"],
        "fair 1950 SC 7": [],
        "none": [],
    })


def test_acts(values):
    check(values, _low(citations.acts_cited), {
        "Section 302, of the I.P.C. and section 302 IPC": ["Section 302 of IPC"],
        "Sec. 5 of the Cr.P.C.; article 21 of the constitution of india":
            ["Article 21 of Constitution", "Sec. 5 of CrPC"],
        "Rule 3 of the Indian Penal Code, Section 498A/34 IPC":
            ["Rule 3 of Indian Penal Code", "Section 498A/34 of IPC"],
        "Section 34 of the Arbitration and\nConciliation Act": [],
        "Section 34 of the Arbitration and Conciliation Act":
            ["Section 34 of Arbitration and Conciliation Act"],
    })


def test_parties(values):
    def shown(c):
        s = parties.sides(normalize.header_lines(c))
        return F.array(parties.petitioner(s), parties.respondent(s), parties.title(s))

    case = "\n(Civil Appeal No. 1 of 2000)\nrest"
    check(values, shown, {
        f"State of A\nv.\nRam Lal{case}": ["State of A", "Ram Lal", "State of A v. Ram Lal"],
        f"A\nRam\nB\nI'.\nShyam{case}": ["Ram", "Shyam", "Ram v. Shyam"],
        f"[1950] 2 S.C.R. 1\n674\nRam\nv ..\nShyam{case}": ["Ram", "Shyam", "Ram v. Shyam"],
        f"Ram Lal vs. Shyam Lal{case}": ["Ram Lal", "Shyam Lal", "Ram Lal v. Shyam Lal"],
        "In Re: Contempt of Mr. Rao": ["In Re", "Contempt of Mr. Rao", "In Re v. Contempt of Mr. Rao"],
        "x\nSUO MOTU  Petition": ["In Re", "SUO MOTU Petition", "In Re v. SUO MOTU Petition"],
        f"Alpha Co\nBeta Co{case}": ["Alpha Co", "Beta Co", "Alpha Co v. Beta Co"],
        f"v.\nRam Lal{case}": [None, None, None],
        f"Ram Lal\nv.{case}": ["Ram Lal", None, "Ram Lal v. "],
        f"{'X' * 300}\nv.\n{'Y' * 300}{case}": ["X" * 200, "Y" * 200, "X" * 300 + " v. " + "Y" * 96],
        "one line": [None, None, None],
        "(Civil Appeal No. 1 of 2000)\nRam\nv.\nShyam": [None, None, None],
        "one\ntwo\nthree\nfour\nfive\nsix\nv.\nseven": ["one", "six", "one v. six"],
        "one\ntw\nth": [None, None, None],
    })


def test_summary(values):
    check(values, lambda c: narrative.summary(c, folded(F.lower(c)), bench.bench_span(c)["end"]), {
        "Issue for Consideration\nWhether the levy is valid?\n\nmore": "Whether the levy is valid?",
        "Summary: This is long enough text\nab rest": "This is long enough text",
        "Summary: short\n\n": None,
        "HEADNOTES: first line of it\nB\n1 more": "first line of it\n1 more",
        "[R. Kapur, J.]\nA a The tenant lost the case in the lower forum\nJUDGMENT":
            "The tenant lost the case in the lower forum",
        "[R. Kapur, J.]\nThe tenant lost the case in the lower forum": None,
    })


def _catchline(line):
    return f"[R. Kapur, J.] {line} next"


CATCHLINES = {
    "a" * 12 + "-b.": [],
    "a" * 13 + "-b.": ["a" * 13, "b"],
    "a" * 246 + "-b.": ["a" * 246, "b"],
    "a" * 247 + "-b.": [],
    "a subject without any sign.": [],
    "one-two-three-four-five-six-seven-eight.": ["one", "two", "three", "four", "five", "six", "seven", "eight"],
    "one-two-three-four-five-six-seven-eight-nine.": [],
    "a single subject only -.": [],
}


@pytest.fixture(scope="module")
def tags():
    return lambda c: narrative.tags(c, folded(F.lower(c)), bench.bench_span(c)["end"])


def test_tags(values, tags):
    check(values, tags, {_catchline(line): found for line, found in CATCHLINES.items()})
    check(values, tags, {
        "List of Keywords \nBail;  two  words ;; x\nCase Arising From": ["Bail", "two words", "x"],
        "List of Keywords\n ; \nCase Arising From" + _catchline("a" * 13 + "-b."): [],
        "Headnotes of it\nBail  granted – b – c": ["Bail granted"],
        "Headnotes of it\nx\nBail – b": [],
        "no sign at all": [],
    })


def test_holding(values):
    check(values, _low(narrative.holding), {
        "Held: " + "x" * 20: None,
        "Held: " + "x" * 21: "x" * 21,
        "Held: the levy was valid [Paras 1, 2] indeed": "the levy was valid  indeed",
        "a\nHELD, the levy was valid in law\nresult: more": "the levy was valid in law",
        "as held, the levy was valid in the law": None,
        "x -Held, first of the decisions made\nObiter: y\nHeld: second of the decisions made":
            "first of the decisions made\n\nsecond of the decisions made",
    })


def test_result(values):
    filler = "x " * 1200
    check(values, _low(narrative.result), {
        "Result of the Case: Appeals partly allowed.": "Partly Allowed",
        "Result of the\n Case : appeal ALLOWED": "Allowed",
        "Result of the Case: dismissed\xa0allowed": "Dismissed",
        "Result of the Case: Disposed of": "Disposed",
        "Result of the Case: remanded. The appeals are  allowed": "Allowed",
        "The appeal stands dismissed": "Dismissed",
        "it is disposed of; writ petition is allowed": "Disposed",
        "writ petition stands dismissed": "Dismissed",
        "appeal is allowed " + filler: "Unknown",
        "nothing": "Unknown",
    })
