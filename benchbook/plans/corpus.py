"""Judgment-like inputs derived from the given tables.

Every row of ``documents`` becomes one judgment: its whole text, with a court header before it
and a result after it. Which form each part takes depends only on the length of the text, so
copies of a text become copies of a judgment. The expressions are plain SQL that both Spark and
the checking engine read, one projection over one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchbook.session import once_per_session
from benchbook.sources.texts import read_texts

NL = "chr(10)"
_QUOTE = "chr(39)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(salt: int, forms: int) -> str:
    return f"((n_chars * {salt} + {salt % 101}) % 10007 % {forms})"


def _choose(salt: int, *forms: str) -> str:
    """One of the SQL string expressions, by the length of the text."""
    arms = " ".join(f"WHEN {i} THEN {form}" for i, form in enumerate(forms[:-1]))
    return f"(CASE {_pick(salt, len(forms))} {arms} ELSE {forms[-1]} END)"


def _t(text: str) -> str:
    """SQL string for a text; ``|`` is a line break, ``~`` an apostrophe."""
    out = []
    for i, line in enumerate(text.split("|")):
        if i:
            out.append(NL)
        for j, piece in enumerate(line.split("~")):
            if j:
                out.append(_QUOTE)
            if piece:
                out.append(f"'{piece}'")
    return "concat(" + ", ".join(out or ["''"]) + ")"


_N = "cast(n_chars % 900 + 1 AS string)"
_YEAR = "cast(1950 + n_chars % 70 AS string)"


def _with_number(text: str) -> str:
    """Like ``_t``, with ``#`` for a number and ``@`` for a year."""
    out = []
    for i, part in enumerate(text.split("#")):
        if i:
            out.append(_N)
        for j, piece in enumerate(part.split("@")):
            if j:
                out.append(_YEAR)
            if piece:
                out.append(_t(piece))
    return "concat(" + ", ".join(out or ["''"]) + ")"


_w = _with_number

PETITIONER = _choose(
    7919,
    _w("State of Punjab"),
    _w("A. B. Krishnan & Sons #"),
    _w("K. Ramesh (Dead) by Lrs."),
    _w("Union of India and Others"),
    _w("Scruton Mills Ltd. #"),
    _w("a b c Mohan Lal"),
    "repeat('Very Long Name of a Society ', 9)",
    _w("CASE DETAILS Gopal Das #"),
    _w("[2011] 7 S.C.R. 318 Hari Singh"),
)
RESPONDENT = _choose(
    6007,
    _w("State of Kerala & Ors."),
    _w("Commissioner of Income Tax, Delhi"),
    _w("M/s. Sharma Traders #"),
    _w("2021 INSC 402 Meera Devi"),
    _w("* * *"),
    _w("Collector of Customs   (Appeals)"),
)
VERSUS = _choose(5003, _t("v."), _t("VERSUS"), _t("vs"), _t("V.P"), _t("v .."), _t("I~."))
PARTIES = _choose(
    3001,
    f"concat({PETITIONER}, {NL}, {VERSUS}, {NL}, {RESPONDENT})",
    f"concat({PETITIONER}, ' vs. ', {RESPONDENT})",
    _w("In Re: Contempt Petition of Mr. Rao #"),
    _w("SUO MOTU WRIT - Prison Conditions in # Jails"),
    f"concat({PETITIONER}, {NL}, {RESPONDENT})",
    f"concat({PETITIONER}, {NL}, 'Bench of ', {NL}, {VERSUS}, {NL}, {RESPONDENT}, {NL}, 'with others')",
)
LEAD = _choose(
    2003,
    _t("IN THE  SUPREME COURT OF INDIA|NOT REPORTABLE|||674||675|676|"),
    _t("A|B|Reportable| "),
    _t(""),
    _t("C |D|"),
)
REPORT_HEADER = _choose(
    1009, _w("[@] 2 S.C.R. #|"), _w("SUPREME COURT REPORTS "), _t(""), _w("@ INSC #|"), _t("")
)
CASE_LINE = _choose(
    4001,
    _w("|(Civil Appeal No. # of @)|"),
    _w("|(Writ Petition (Civil) Nos. 12-14 & # of @)|"),
    _w("|SLP (Crl.) No(s). # & 56/A   of @|"),
    _t("|"),
    _w("|criminal appeal no # of @ decided|"),
)
DATE = _choose(
    8009,
    _w("30 September @|"),
    _w("September 3, @|"),
    _w("@. December 21|"),
    _w("03-11-@|"),
    _w("01/02/@ and 5th, 7. march, @|"),
    _w("May 4|"),
    _t(""),
)
BENCH = _choose(
    9001,
    _t("[R. K. Sharma,* and Hon~ble B. P. Sinha, JJ.]|"),
    _t("(P. N. BHAGWATI, C.J. AND V. R. KRISHNA IYER, J.)|"),
    _t("[HARILAL KANIA, CJ and MEHR CHAND  MAHAJAN, JJ.J|"),
    _t("CORAM: Justice A. Kumar & Dr. Bose, Abcd; Shri K. Subba Rao||"),
    _t("[Held by this Court, on appeal, JJ.]|CORAM - Mr. Justice M. H. Beg||"),
    _t(""),
    _t("[Constitution Bench, S. R. Das, CJI ]|"),
    _t("(M. Hidayatullah, CJI and J. C. Shah, CJJ"),
)
AFTER_BENCH = _choose(
    1511,
    _t("Motor Vehicles-Goods Carriage-Levy under municipal by-law-Validity of-Scope. The rest follows|"),
    _t("Issue for Consideration|Whether the levy is valid under the rules?|B|It was. Next|"),
    _t("HEADNOTES: whether the notification was published in time||"),
    _t("A a The appellant was a tenant of the premises in dispute|C|for ten years. J U D G M E N T|"),
    _t("Land-tax.|"),
    _t("Summary: short||"),
    _t(""),
)
TAG_PART = _choose(
    1811,
    _t("List of Keywords|Bonus; Industrial   dispute ;; Customary| payment|Case Arising From|"),
    _t("Headnotes of the case|Bail   granted – conditions – surety|"),
    _t("List of Keywords  | ; |Case Arising From|"),
    _t(""),
)
HOLDING = _choose(
    2111,
    _t("|Held: the levy was valid in law [Paras 11, 12] and the claim fails.|Result:|"),
    _t("|Held, short|"),
    _t(" grove and pas-ture -Held, order of the tribunal was restored|below: more|"),
    _t("|Held: that the workmen were entitled to bonus.|Obiter: none.|HELD : second part of the decision [Para 4]|end: x|"),
    _t(""),
)
CITES = _choose(
    2203,
    _w("See (@) 10 SCC # and (@) 10 S.C.C. #. "),
    _w("A.I.R. @ S.C. # was followed; AIR @ SC # too. "),
    _w("[@] 2 SCR # and @ INSC #. "),
    _w("[@]  4 S.C.R. 25, (1994)  3 scc 1, 2019 insc 7. "),
    _t(""),
)
ACTS = _choose(
    2309,
    _w("Section #, of the I.P.C. and Section # IPC. "),
    _w("Article 14 of the Constitution of India; article 21A of Constitution. "),
    _w("Order 39(1) of the Code of Civil  Procedure; Order 39(1) of the Code of Civil Procedure; Sec. 5 of the Cr.P.C. "),
    _w("Rule 3 of the Indian Penal Code and Section 34 of the Arbitration and Conciliation Act, Section 138 N.I. Act. "),
    _t(""),
    _w("Section #/2 of the M.V.  Act, Art. 32 of the constitution of india. "),
)
RESULT = _choose(
    2411,
    _t("|Result of the Case: Appeals partly allowed.|"),
    _t("|Result of the  Case : Appeal allowed.|"),
    f"concat({_t('|Result of the Case: Appeal dismissed')}, chr(160), 'allowed')",
    _t("|Result of the case: Petition disposed of|"),
    _t("|Result of the Case: remanded.|The appeals are  allowed.|"),
    _t("|The appeal stands dismissed.|"),
    _t("|The writ petition is allowed.|"),
    _t(""),
    _t("|The matter is disposed of. It is partly allowed.|"),
)
LEGAL_PARAGRAPH = _choose(
    2503,
    _t("|The judgment of the court below was taken in appeal by the petitioner against the respondent "
       "under the section; the order of the bench, coram present, is held good.|"),
    _t("|The petitioner moved this court against the order.|"),
    _t("|"),
)

# the SQL string expression over documents(n_chars, text)
RAW_TEXT = "concat(" + ", ".join(
    [LEAD, REPORT_HEADER, PARTIES, CASE_LINE, DATE, BENCH, AFTER_BENCH, TAG_PART, LEGAL_PARAGRAPH,
     CITES, ACTS, "text", HOLDING, RESULT]
) + ")"
JUDGMENT_KEY = (
    "concat('data/pdf/year=', cast(1950 + doc_id % 76 AS string), '/english/', "
    "lpad(cast(doc_id AS string), 9, '0'), '_EN.pdf')"
)
KEY_YEAR = "cast(1950 + doc_id % 76 AS int)"

# object keys: one per order
ORDER_KEY = (
    "concat('data/pdf/year=', cast(year(o_orderdate) AS string), "
    "CASE WHEN o_orderkey % 11 = 3 THEN '/hindi/' ELSE '/english/' END, "
    "lpad(cast(o_orderkey AS string), 9, '0'), "
    "CASE WHEN o_orderkey % 7 = 0 THEN '_EN.txt' WHEN o_orderkey % 5 = 0 THEN '_EN.PDF' "
    "ELSE '_EN.pdf' END)"
)


@once_per_session
def _raw_columns() -> list[Column]:
    return [
        F.expr(JUDGMENT_KEY).alias("key"),
        F.expr(KEY_YEAR).alias("key_year"),
        F.expr(RAW_TEXT).alias("raw_text"),
    ]


def raw_judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, key_year, raw_text``: one judgment per document, before clean-up."""
    documents = read_texts(spark, f"{sf_dir}/documents.parquet", "doc_id")
    return documents.select(*_raw_columns())


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, year``: one object key per order."""
    return table(spark, sf_dir, "orders").select(
        F.expr(ORDER_KEY).alias("key"), F.expr("cast(year(o_orderdate) AS int)").alias("year")
    )


PAGE_LINES = 6


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, page_no, page_text``: each raw text cut every few lines."""
    lines = F.split("raw_text", "\n", -1)
    cuts = F.sequence(F.lit(0), F.floor((F.size(lines) - 1) / PAGE_LINES).cast("int"))
    texts = F.transform(
        cuts,
        lambda p: F.array_join(F.slice(lines, p * PAGE_LINES + 1, F.lit(PAGE_LINES)), "\n"),
    )
    cut = raw_judgments(spark, sf_dir).select("key", F.posexplode(texts).alias("page_no", "page_text"))
    return cut.withColumn("page_no", F.col("page_no") + 1)


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source, key, status, error_msg, processed_at``: the events as log entries."""
    return table(spark, sf_dir, "events").select(
        F.expr("concat('s', cast(event_id % 3 AS string))").alias("source"),
        F.expr("cast(user_id AS string)").alias("key"),
        F.expr("CASE WHEN event_type = 'purchase' THEN 'done' ELSE event_type END").alias("status"),
        F.expr("CASE WHEN event_type = 'error' THEN props END").alias("error_msg"),
        F.col("ts").alias("processed_at"),
    )


def party_names(number: str, name: str) -> str:
    """SQL expression: a customer's name with the residue party names come with."""
    return f"""(CASE {number} % 11
        WHEN 0 THEN concat('A b  ', {name}) WHEN 1 THEN concat('CASE DETAILS ', {name})
        WHEN 2 THEN concat('Digital Supreme Court Reports ', {name})
        WHEN 3 THEN concat('[2011] 7 S.C.R. 318 ', {name})
        WHEN 4 THEN concat('2022 INSC 56 ', {name}) WHEN 5 THEN concat('-- ', {name}, ' & ;')
        WHEN 6 THEN concat('Mr. Scrope of ', {name}, '   Ltd.') WHEN 7 THEN concat('"', {name}, '" (Dead)')
        WHEN 8 THEN NULL WHEN 9 THEN concat('A. B. ', {name}) ELSE {name} END)"""


def act_names(number: str, name: str) -> str:
    """SQL expression: spellings of statutes before a part's name."""
    return f"""concat((CASE {number} % 13
        WHEN 0 THEN 'I.P.C.' WHEN 1 THEN 'i.p.c' WHEN 2 THEN 'Cr.P.C.' WHEN 3 THEN 'Code of  Criminal Procedure'
        WHEN 4 THEN 'C.P.C.' WHEN 5 THEN 'code of civil procedure' WHEN 6 THEN 'N.I. Act'
        WHEN 7 THEN 'M.V.   Act' WHEN 8 THEN 'Constitution of India' WHEN 9 THEN 'Indian Penal Code'
        WHEN 10 THEN 'IPC' WHEN 11 THEN 'CrPC' ELSE 'Evidence Act' END), '  ', {name})"""
