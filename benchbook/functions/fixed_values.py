"""Patterns, word lists, lengths and labels the results depend on.

The patterns are plain regular expressions with Unicode ``\\s``/``\\w``/``\\b`` and an
absolute-end ``\\Z``; ``regex.jvm`` spells them for the JVM engine.

The engine tries every position. A look-ahead, ``\\b`` or choice there costs several times a plain
character class, so the forms named ``..._FAST``, which find the same, take their first
characters by classes and look back for the rest.
"""

# ---- text normalisation ------------------------------------------------------------
BANNER = r"in\s+the\s+supreme\s+court\s+of\s+india\s*"
REPORTABLE = r"not\s+reportable\s*|reportable\s*"
REPORTABLE_FAST = r"(?-i:[nNrR][oOeE][tTpP])(?:(?<=rep)ortable|(?<=not)\s+reportable)\s*"
PAGE_NUMBER_LINE = r"\n\s*\d{1,4}\s*\n"
# a match never begins after another line break of the same blank run, so only the first one is
# tried; long blank runs would cost the square of their length otherwise
PAGE_NUMBER_START = r"(?=\n[\s\d])(?<!\n\s{0,99})"
PAGE_NUMBER_FAST = r"\n(?=[\s\d])(?<!\n\s{0,99}\n)\s*\d{1,4}\s*\n"
MARGIN_LETTER_LINE = r"\n\s*[A-H]\s*\n"
LONE_LETTERS = r"^(?:\b[a-zA-Z]\b\s*)+"
EDGE_PUNCTUATION = r"^[^\w]+|[^\w]+$"

# ---- windows and truncation, in characters -------------------------------------------
HEADER_CHARS = 6000
BENCH_CHARS = 3000
TITLE_CHARS = 1200
TAIL_CHARS = 2000
AFTER_BENCH_CHARS = 400
PARTY_MAX = 200
TITLE_MAX = 400
SUMMARY_MAX = 2000

# ---- case number and date (searched in the collapsed header) ---------------------------
CASE_NUMBER = (
    r"\b(Civil Appeal|Writ Petition|Criminal Appeal|SLP|Special Leave Petition|Transfer Petition|"
    r"Review Petition|Curative Petition|Original Suit|Case|Reference|Appeal|Petition)"
    r"\s*(?:\([^)]*\))?\s*(?:Nos?\.?|No\(s\)\.?)\s*([A-Za-z0-9lI\-\/,\s\&]+?)\s*of\s*(\d{4})\b"
)
MONTH = (
    r"(?:January|February|March|April|May|June|July|August|September|October|November|December|"
    r"Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)[a-z]*"
)
# tried in this order; the first pattern that occurs wins
DATES = (
    r"\b(\d{1,2}[\s\.,\-]+" + MONTH + r"[\s\.,\-]+\d{4})\b",
    r"\b(" + MONTH + r"[\s\.,\-]*\d{1,2}[\s\.,\-]*\d{4})\b",
    r"\b(\d{4}[\s\.,\-]*" + MONTH + r"[\s\.,\-]*\d{1,2})\b",
    r"\b(\d{1,2}[\-\/]\d{1,2}[\-\/]\d{4})\b",
)
# how a match of these patterns begins (any case); put before the pattern as a look-ahead it
# turns most positions down at once
CASE_NUMBER_START = "(?=[cwstroap][irlpeua][viepasrft])"
DATE_STARTS = (
    r"(?=\d)", "(?-i:(?=[jfmasondJFMASOND\u017f][aceopuACEOPU][bcglnprtvyBCGLNPRTVY]))", r"(?=\d)",
    r"(?=\d)",
)
DATES_FAST = (
    r"\d(?<=\b\d)\d?[\s\.,\-]+" + MONTH + r"[\s\.,\-]+\d{4}\b",
    # a month's first three letters; the rest of its name is letters like those that may follow
    r"(?-i:[jfmasondJFMASOND\u017f][aceopuACEOPU][bcglnprtvyBCGLNPRTVY])"
    r"(?<=\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec))"
    r"[a-z]*[\s\.,\-]*\d{1,2}[\s\.,\-]*\d{4}\b",
    r"\d(?<=\b\d)\d{3}[\s\.,\-]*" + MONTH + r"[\s\.,\-]*\d{1,2}\b",
    r"\d(?<=\b\d)\d?[\-\/]\d{1,2}[\-\/]\d{4}\b",
)
YEAR_WORD = r"\b(\d{4})\b"
YEAR_IN_KEY = r"year=(\d{4})|/(\d{4})/"

# ---- bench ---------------------------------------------------------------------------
BENCH_SQUARE = r"\[([^\[\]]+?(?:JJ|CJI|J\.?))\s*\]"
BENCH_ROUND = r"\(([^\(\)]+?(?:JJ|CJI|J\.?))\s*\)"
JUDGE_MARK = r"(?:JJ\.?|CJI\.?|C\.?J\.?)"
JUDGE_MARK_FAST = r"[jJ](?:[jJ]|(?<=[cC]\.?[jJ]))"  # tells whether there is a mark, not its extent
JUDGE_LIST_SIGN = r",|\band\b"
CORAM = r"\bCORAM\b\s*[:\-]?\s*(.*?)(?=\n\n|\Z)"
CORAM_MAX = 200
JUDGE_SEPARATOR = r",|\band\b|&|;"
JUDGE_SUFFIX = r"\b(?:JJ\.?|J\.?|CJI\.?|C\.?J\.?|C\.?J\.?I\.?)\s*$"
JUDGE_HONORIFIC = r"^\s*\b(?:Hon'ble|Justice|Mr\.?|Mrs\.?|Shri|Smt\.?|Dr\.?)\b"
JUDGE_NAME_MIN = 4
NOT_A_JUDGE = (
    "held", "court", "appeal", "petition", "plaintiff", "defendant", "non-judice", "nonjudice",
    "decree", "embargo", "judgement", "judgment", "industrial", "companies", "provisions",
    "arising", "suit", "interim", "order", "application",
)
FULL_BENCH_NAME = "Constitution Bench"
FULL_BENCH_SENTENCE = (
    "Binding on all courts in India. Applied in all cases involving constitutional questions."
)
BENCH_SENTENCE = "Binding on all lower courts. Decided by %s-Judge Bench."

# ---- citations: pattern and canonical form ---------------------------------------------
CITATIONS = {
    "scc": (r"\((\d{4})\)\s*(\d+)\s*S\.?C\.?C\.?\s*(\d+)", "($1) $2 SCC $3"),
    "air": (r"\bA\.?I\.?R\.?\s*(\d{4})\s*S\.?C\.?\s*(\d+)\b", "AIR $1 SC $2"),
    "scr": (r"\[(\d{4})\]\s*(\d+)\s*S\.?C\.?R\.?\s*(\d+)", "[$1] $2 SCR $3"),
    "insc": (r"\b(\d{4})\s*INSC\s*(\d+)\b", "$1 INSC $2"),
}

# text a citation of the kind cannot do without, in lower case
CITATION_WORDS = {
    "scc": ("scc", "s.cc", "sc.c", "s.c.c"),
    "air": ("air", "a.ir", "ai.r", "a.i.r"),
    "scr": ("scr", "s.cr", "sc.r", "s.c.r"),
    "insc": ("insc",),
}

CITATION_STARTS = {"scc": "", "air": "", "scr": "", "insc": r"(?=\d)"}
CITATIONS_FAST = {
    "scc": CITATIONS["scc"][0],
    "air": r"(?-i:[aA])(?<=\b.)\.?I\.?R\.?\s*\d{4}\s*S\.?C\.?\s*\d+\b",
    "scr": CITATIONS["scr"][0],
    "insc": r"\d(?<=\b\d)\d{3}\s*INSC\s*\d+\b",
}

# ---- statutes ------------------------------------------------------------------------
ACT_NAMES = (
    r"(?:Indian Penal Code|IPC|I\.?P\.?C\.?|Code of Criminal Procedure|CrPC|Cr\.?P\.?C\.?|"
    r"Code of Civil Procedure|CPC|C\.?P\.?C\.?|Constitution of India|Constitution|BNS|B\.?N\.?S\.?|"
    r"Income Tax Act|GST Act|Companies Act|Arbitration.*?Act|NDPS Act|N\.?D\.?P\.?S\.?\s+Act|"
    r"Prevention of Corruption Act|P\.?C\.?\s+Act|Specific Relief Act|Evidence Act|Indian Evidence Act|"
    r"Limitation Act|Contract Act|Indian Contract Act|Motor Vehicles Act|M\.?V\.?\s+Act|"
    r"Negotiable Instruments Act|N\.?I\.?\s+Act|Industrial Disputes Act|I\.?D\.?\s+Act|"
    r"SARFAESI Act|SARFAESI|Transfer of Property Act|T\.?P\.?\s+Act)"
)
PROVISION = (
    r"\b(Section|Sec\.?|Article|Art\.?|Order|Rule)\s+(\d+[\w\(\)\-\/,]*)\s+"
    r"(?:of\s+)?(?:the\s+)?(" + ACT_NAMES + r")\b"
)
PROVISION_FAST = (
    r"(?-i:[saorSAOR\u017f][eruERU][ctdlCTDL])(?<=\b...)"
    r"(?:(?<=sec)(?:tion|\.)?|(?<=art)(?:icle|\.)?|(?<=ord)er|(?<=rul)e)\s+\d+[\w\(\)\-\/,]*\s+"
    r"(?:of\s+)?(?:the\s+)?" + ACT_NAMES + r"\b"
)
PROVISION_WORDS = ("sec", "art", "order", "rule")
PROVISION_START = "(?-i:(?=[saorSAOR\u017f][eruERU][ctdlCTDL]))"
# applied in this order
ACT_SHORT_NAMES = (
    (r"\bI\.?P\.?C\.?\b", "IPC"),
    (r"\bCr\.?P\.?C\.?\b|\bCode of Criminal Procedure\b", "CrPC"),
    (r"\bC\.?P\.?C\.?\b|\bCode of Civil Procedure\b", "CPC"),
    (r"\bN\.?I\.?\s+Act\b", "Negotiable Instruments Act"),
    (r"\bM\.?V\.?\s+Act\b", "Motor Vehicles Act"),
    (r"\bConstitution of India\b", "Constitution"),
)

# ---- parties -------------------------------------------------------------------------
# stripped from a party name in this order
PARTY_NOISE = (
    r"^\s*CASE\s+DETAILS\s*",
    r"^\s*(?:DIGITAL\s+)?SUPREME\s+COURT\s+(?:REPORTS|OF\s+INDIA)\s*",
    r"^.*?\bS\.?C\.?R\.?(?:\s*\d+)?\s*",
    r"^\s*\d{4}\s*INSC\s*\d+\s*",
)
PARTY_NOISE_FAST = (
    *PARTY_NOISE[:2],
    r"^.*?(?-i:[sS\u017f])(?<=\b.)\.?C\.?R\.?(?:\s*\d+)?\s*",
    PARTY_NOISE[3],
)
PARTY_EDGES = r"""^[^\w\("'\.\s]+|[^\w\)"'\.\s]+$"""
IN_RE_LINE = r"^\s*(?:IN\s+RE\b|RE\b\s*[\-:]|SUO\s+MOTU\b)"
IN_RE_LINES = 15
IN_RE_NAME = "In Re"
CASE_LINE = r"\(\s*[A-Za-z\s\(\)]+\s+(?:No|Nos)\b"
CASE_LINE_LINES = 18
TITLE_LINES = 6
REPORT_HEADER_LINE = r"\[\d{4}\].*S\.?C\.?R"
SHORT_LINE = 2
VERSUS = (
    "v", "vs", "versus", "v.", "vs.", "v.p", "v.s", "i'.", "i'", "v.p.", "v.r", "v,", "v..",
)
VERSUS_START = r"\A[^\w]*+[vViI]"  # the first letter of each of them
VERSUS_LINES = ("v ..", "I'.", "v.p")
VERSUS_INLINE = r"\s+\b(?:v|vs|versus|v\.p|v\.s|I'\.)\b\.?\s+"

# ---- narrative parts -------------------------------------------------------------------
SUMMARY_MARKER = (
    r"(?:Issue for consideration|HEADNOTE[S]?|Summary)\s*[:\-]?\s*(.+?)(?=\n\n|\n[A-Z][a-z]+|\Z)"
)
SUMMARY_MARKER_START = "(?-i:(?=[ihsIHS\u0130\u0131\u017f][seuSEU\u017f]))"
SUMMARY_WORDS = ("issue for consideration", "headnote", "summary")
SUMMARY_MARKER_MIN = 20
SUMMARY_STOP = (
    r"\b(?:Case Law Reference|CIVIL ORIGINAL JURISDICTION|CRIMINAL APPELLATE JURISDICTION|JUDGMENT|"
    r"O\s*R\s*D\s*E\s*R|J\s*U\s*D\s*G\s*M\s*E\s*N\s*T|For Appellant|For Respondent)\b"
)
SUMMARY_STOP_START = r"(?-i:(?=[cjofCJOF][airuoAIRUO\u0130\u0131\s]))"
SUMMARY_POST_BENCH_MIN = 30
KEYWORD_SECTION = r"List of Keywords\s*\n(.*?)\nCase Arising From"
KEYWORD_WORDS = ("list of keywords",)
HEADNOTE_WORDS = ("headnotes",)
HELD_WORDS = ("held",)
RESULT_LINE_WORDS = ("result of the",)
HEADNOTE_LINE = r"Headnotes.*?\n(.*?)–"
CATCHLINE = r"^(.+?\.)\s"
CATCHLINE_LENGTH = (15, 250)  # both ends excluded
CATCHLINE_TAGS = (2, 8)  # both ends included
HELD = r"(?:^|[\n\-])\s*Held\s*[:,]\s*(.*?)(?=\n[A-Z][a-z]+:|\Z)"
HELD_START = r"(?:(?=-)|(?:^|(?=\n))(?:\G|(?<!\n\s{0,99})))"  # as for page numbers; a passage may end inside a run
# in a text with a line break put before it, which stands for the line that begins the text
HELD_FAST = (
    r"[\n\-](?=[\shH])(?:(?<=-)|(?<=\G\n)|(?<!\n\s{0,99}\n))"
    r"\s*Held\s*[:,]\s*(.*?)(?=\n[A-Z][a-z]+:|\Z)"
)
HELD_SIGN = r"held\s*[:,]"  # in the folded text; begins with a fixed word, so it is found fast
HELD_MIN = 20
PARA_NOTE = r"\[Para.*?\]"

# ---- result ----------------------------------------------------------------------------
RESULT_LINE = r"Result of the\s+Case\s*:\s*([^\n\.\xa0]+)"
RESULT_WORDS = (
    ("partly allowed", "Partly Allowed"),
    ("allowed", "Allowed"),
    ("dismissed", "Dismissed"),
    ("disposed", "Disposed"),
)
# in this order: words the pattern cannot do without, pattern, result
RESULT_TAIL = (
    (("partly", "allowed"), r"\bpartly\s+allowed\b", "Partly Allowed"),
    (
        ("appeal", "allowed"),
        r"\bappeal\s+is\s+allowed\b|\bappeals\s+are\s+allowed\b|\bappeal\s+stands\s+allowed\b",
        "Allowed",
    ),
    (
        ("appeal", "dismissed"),
        r"\bappeal\s+is\s+dismissed\b|\bappeals\s+are\s+dismissed\b|\bappeal\s+stands\s+dismissed\b",
        "Dismissed",
    ),
    (("disposed",), r"\bdisposed\s+of\b", "Disposed"),
    (
        ("writ", "petition", "allowed"),
        r"\bwrit\s+petition\s+is\s+allowed\b|\bwrit\s+petition\s+stands\s+allowed\b",
        "Allowed",
    ),
    (
        ("writ", "petition", "dismissed"),
        r"\bwrit\s+petition\s+is\s+dismissed\b|\bwrit\s+petition\s+stands\s+dismissed\b",
        "Dismissed",
    ),
)
RESULT_UNKNOWN = "Unknown"

# ---- quality ---------------------------------------------------------------------------
LEGAL_WORDS = (
    "judgment", "appeal", "petitioner", "respondent", "court",
    "section", "order", "bench", "coram", "held",
)
MIN_WORDS = 100
MIN_QUALITY = 0.25
SCANNED_PAGE_CHARS = 50
WEAK_FIELD_PERCENT = 30

# ---- log statuses and report fields ------------------------------------------------------
DONE, DUPLICATE, LOW_QUALITY, ERROR = "done", "duplicate", "low_quality", "error"
REPORT_FIELDS = (
    "title", "case_number", "case_type", "year", "judgment_date",
    "bench", "petitioner", "respondent", "result",
    "acts_cited", "cases_cited", "tags", "summary", "holding",
    "applicability", "quality_score",
)
SAMPLE_YEARS = (1950, 1960, 1970, 1980, 1990, 2000, 2010, 2020, 2024)
FIRST_YEAR, LAST_YEAR = 1950, 2025
KEY_ROOT = "data/pdf/"
LANGUAGE = "english"
