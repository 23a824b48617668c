"""The registered queries again, as plain SQL for an independent engine.

That engine's patterns know no look-ahead and only ASCII ``\\s``/``\\w``, so white space is spelled
out and the few look-aheads become consumed terminators.
"""

from __future__ import annotations

from benchbook.functions import fixed_values as V
from benchbook.plans import corpus

_SPACE = r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_WORD = r"\p{L}\p{N}_"
_WS = f"[{_SPACE}]"


def _re(pattern: str, flags: str = "") -> str:
    """A plain pattern as a quoted SQL literal."""
    out, in_class, i = [], False, 0
    while i < len(pattern):
        pair = pattern[i : i + 2]
        if pair in (r"\s", r"\w"):
            inner = _SPACE if pair == r"\s" else _WORD
            out.append(inner if in_class else f"[{inner}]")
            i += 2
        elif pair == r"\Z":
            out.append(r"\z")
            i += 2
        elif pair[0] == "\\":
            out.append(r"\x{A0}" if pattern[i : i + 4] == r"\xa0" else pair)
            i += 4 if pattern[i : i + 4] == r"\xa0" else 2
        else:
            in_class = pair[0] == "[" or (in_class and pair[0] != "]")
            out.append(pair[0])
            i += 1
    text = (f"(?{flags})" if flags else "") + "".join(out)
    return "'" + text.replace("'", "''") + "'"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _collapse(x: str) -> str:
    return _strip(f"regexp_replace({x}, '{_WS}+', ' ', 'g')")


def _sub(x: str, pattern: str, to: str = "''", flags: str = "") -> str:
    return f"regexp_replace({x}, {_re(pattern, flags)}, {to}, 'g')"


def _first(x: str, pattern: str, group: int = 1, flags: str = "") -> str:
    return f"regexp_extract({x}, {_re(pattern, flags)}, {group})"


def _all(x: str, pattern: str, group: int = 0, flags: str = "") -> str:
    return f"regexp_extract_all({x}, {_re(pattern, flags)}, {group})"


def _has(x: str, pattern: str, flags: str = "") -> str:
    return f"regexp_matches({x}, {_re(pattern, flags)})"


def _joined(x: str) -> str:
    return f"array_to_string({x}, ' | ')"


def _title_case(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({x}), ' '), "
        f"lambda w: upper(w[1]) || w[2:]), ' ')"
    )


_NL = corpus.NL


# ---- text ------------------------------------------------------------------------------


def clean(x: str) -> str:
    x = _sub(x, V.BANNER, flags="i")
    x = _sub(x, V.REPORTABLE, flags="i")
    x = _sub(x, V.PAGE_NUMBER_LINE, _NL)
    x = _sub(x, r"\n{3,}", f"concat({_NL}, {_NL})")
    x = _sub(x, r"[ \t]{2,}", "' '")
    x = _sub(x, r"[\x0c\x0b]", f"concat({_NL}, {_NL})")
    return _strip(x)


def party_name(x: str) -> str:
    x = _strip(_sub(f"coalesce({x}, '')", V.LONE_LETTERS))
    for noise in V.PARTY_NOISE:
        x = _strip(_sub(x, noise, flags="i"))
    return _collapse(_sub(x, V.PARTY_EDGES))


def act_name(x: str) -> str:
    x = f"regexp_replace({x}, '{_WS}+', ' ', 'g')"
    for pattern, short in V.ACT_SHORT_NAMES:
        x = _sub(x, pattern, _q(short), "i")
    return _strip(x)


# ---- common tables -----------------------------------------------------------------------

_RAW = f"""raw AS (
  SELECT {corpus.JUDGMENT_KEY} AS key, {corpus.KEY_YEAR} AS key_year, {corpus.RAW_TEXT} AS raw_text
  FROM documents)"""
_J = f"""{_RAW}, j AS (SELECT key, key_year, {clean('raw_text')} AS t FROM raw)"""


def over_text(select: str) -> str:
    return f"WITH {_J} SELECT {select} FROM j"


# quality
WORDS = f"len(list_filter(regexp_split_to_array(t, '{_WS}+'), lambda w: w <> ''))::BIGINT"
ALPHA = r"length(regexp_replace(t, '\P{L}', '', 'g'))::DOUBLE / greatest(length(t), 1)"
HITS = "(" + " + ".join(f"contains(lower(t), '{w}')::INTEGER" for w in V.LEGAL_WORDS) + ")::BIGINT"
_SCALE = str(1 << 60)
_Q = f"""q0 AS (SELECT *, {ALPHA} * 0.5::DOUBLE + ({HITS} / 10.0::DOUBLE) * 0.5::DOUBLE AS x,
    {WORDS} AS words FROM j),
  q1 AS (SELECT *, floor(x * 1000)::HUGEINT AS whole,
    ((x * {_SCALE}::DOUBLE)::HUGEINT * 1000 - floor(x * 1000)::HUGEINT * {_SCALE}) * 2 AS twice FROM q0),
  q AS (SELECT key, key_year, t, sha256(t) AS content_hash,
    CASE WHEN words < {V.MIN_WORDS} THEN 0.0::DOUBLE
      ELSE (whole + CASE WHEN twice > {_SCALE} OR (twice = {_SCALE} AND whole % 2 = 1) THEN 1 ELSE 0 END
        )::DOUBLE / 1000.0::DOUBLE END AS quality_score FROM q1)"""


def over_quality(select: str) -> str:
    return f"WITH {_J}, {_Q} SELECT {select} FROM q"


# case line, date, year
_HEADER = _collapse(f"left(t, {V.HEADER_CHARS})")
_CASE_HIT = _first("hd", V.CASE_NUMBER, 0, "i")
_TYPE = _title_case(_strip(_first("hd", V.CASE_NUMBER, 1, "i")))
CASE_TYPE = f"CASE WHEN {_CASE_HIT} <> '' THEN {_TYPE} END"
CASE_NUMBER = (
    f"CASE WHEN {_CASE_HIT} <> '' THEN {_TYPE} || ' No. ' || "
    f"{_collapse(_first('hd', V.CASE_NUMBER, 2, 'i'))} || ' of ' || "
    f"{_first('hd', V.CASE_NUMBER, 3, 'i')} END"
)
CASE_YEAR = f"try_cast({_first('hd', V.CASE_NUMBER, 3, 'i')} AS INTEGER)"
DATE = _strip("coalesce(" + ", ".join(f"nullif({_first('hd', p, 1, 'i')}, '')" for p in V.DATES) + ")")
YEAR = (
    f"coalesce(nullif(try_cast({_first('judgment_date', V.YEAR_WORD)} AS INTEGER), 0), "
    f"nullif(try_cast(regexp_extract({_first('key', V.YEAR_IN_KEY, 0)}, '[0-9]{{4}}') AS INTEGER), 0), "
    f"case_year)"
)
_H = f"h0 AS (SELECT *, {_HEADER} AS hd FROM j)"
_C = f"""{_H}, c0 AS (SELECT *, {CASE_TYPE} AS case_type, {CASE_NUMBER} AS case_number,
    {CASE_YEAR} AS case_year, {DATE} AS judgment_date FROM h0),
  c AS (SELECT *, {YEAR} AS year FROM c0)"""


def over_case(select: str) -> str:
    return f"WITH {_J}, {_C} SELECT {select} FROM c"


# bench
def _closed(pattern: str) -> tuple[str, str]:
    raw = _strip(_first("w", pattern, 1, "i"))
    return raw, f"length(regexp_extract(w, {_re('^.*?' + pattern, 'is')}, 0))"


_SQ_RAW, _SQ_END = _closed(V.BENCH_SQUARE)
_RD_RAW, _RD_END = _closed(V.BENCH_ROUND)
_B = f"""b0 AS (SELECT key, left(t, {V.BENCH_CHARS}) AS w FROM j),
  ba AS (SELECT key, w, k, list_sum(list_transform(parts[1:k], lambda x: length(x)))::BIGINT + k AS i
    FROM (SELECT key, w, parts, unnest(range(1, len(parts))) AS k
      FROM (SELECT key, w, regexp_split_to_array(w, '[\\[(]') AS parts FROM b0))),
  b1 AS (SELECT key, w, i, i + length(regexp_extract(substring(w, i + 1), '^{_WS}*')) AS o
    FROM ba WHERE regexp_matches(substring(w, i + 1), '^{_WS}*[A-Z]')),
  b2 AS (SELECT key, i, o, string_split(substring(w, o + 1, {V.AFTER_BENCH_CHARS}), {_NL} || {_NL})[1] AS block FROM b1),
  b3 AS (SELECT *, {_all('block', V.JUDGE_MARK, 0, 'i')} AS marks,
    regexp_split_to_array(block, {_re(V.JUDGE_MARK, 'i')}) AS pieces FROM b2),
  b4 AS (SELECT *, length(block) - length(pieces[-1]) AS stop FROM b3 WHERE len(marks) > 0),
  b5 AS (SELECT key, arg_min({_strip('left(block, stop)')}, i) AS raw, arg_min(o + stop, i) AS stop
    FROM b4 WHERE {_has('left(block, stop - length(marks[-1]))', V.JUDGE_LIST_SIGN, 'i')} GROUP BY key),
  span AS (SELECT b0.key,
    coalesce(nullif({_SQ_RAW}, ''), nullif({_RD_RAW}, ''), b5.raw) AS bench_raw,
    coalesce(nullif({_SQ_END}, 0), nullif({_RD_END}, 0), b5.stop)::BIGINT AS bench_end
    FROM b0 LEFT JOIN b5 ON b0.key = b5.key)"""


def _names(raw: str) -> str:
    name = _sub(_strip("seg"), V.JUDGE_SUFFIX, "''", "i")
    name = _sub(name, V.JUDGE_HONORIFIC, "''", "i")
    name = _collapse(_sub(f"replace({name}, '*', '')", V.EDGE_PUNCTUATION))
    words = "[" + ", ".join(_q(w) for w in V.NOT_A_JUDGE) + "]"
    return (
        f"list_filter(list_transform(regexp_split_to_array(regexp_replace(coalesce({raw}, ''), "
        f"'{_WS}+', ' ', 'g'), {_re(V.JUDGE_SEPARATOR, 'i')}), lambda seg: {name}), "
        f"lambda n: length(n) > {V.JUDGE_NAME_MIN} AND "
        f"len(list_filter({words}, lambda w: contains(lower(n), w))) = 0)"
    )


_CORAM = _strip(
    f"regexp_extract(left(t, {V.BENCH_CHARS}), "
    + _re(V.CORAM.replace(r"(?=\n\n|\Z)", r"(?:\n\n|\Z)"), "is")
    + ", 1)"
)
_N = f"""{_B}, n0 AS (SELECT j.*, bench_raw, bench_end, {_names('bench_raw')} AS listed,
    {_CORAM} AS coram FROM j JOIN span ON j.key = span.key),
  n AS (SELECT *, CASE WHEN len(listed) > 0 THEN listed
    WHEN length(coram) < {V.CORAM_MAX} THEN {_names('coram')} ELSE [] END AS bench FROM n0)"""
APPLICABILITY = (
    f"CASE WHEN len(list_filter(bench, lambda n: contains(n, '{V.FULL_BENCH_NAME}'))) > 0 "
    f"THEN {_q(V.FULL_BENCH_SENTENCE)} WHEN len(bench) > 0 THEN "
    f"{_q(V.BENCH_SENTENCE).replace('%s', chr(39) + ' || len(bench) || ' + chr(39))} END"
)


def over_bench(select: str) -> str:
    return f"WITH {_J}, {_N} SELECT {select} FROM n"


# citations and statutes
def _cites(kind: str) -> str:
    pattern, form = V.CITATIONS[kind]
    for g in "123":
        form = form.replace("$" + g, "\\" + g)
    return (
        f"list_transform({_all('t', pattern, 0, 'i')}, "
        f"lambda m: regexp_replace(m, {_re(pattern, 'i')}, {_q(form)}))"
    )


def cites_of_kind(kind: str) -> str:
    return f"list_sort(list_distinct({_cites(kind)}))"


CITES = "list_sort(list_distinct(" + "list_concat(" * 3 + _cites("scc") + "".join(
    f", {_cites(k)})" for k in ("air", "scr", "insc")
) + "))"
_ACT = (
    f"{_title_case(_strip(_first('m', V.PROVISION, 1, 'i')))} || ' ' || "
    f"rtrim({_strip(_first('m', V.PROVISION, 2, 'i'))}, ',') || ' of ' || "
    f"{act_name(_strip(_first('m', V.PROVISION, 3, 'i')))}"
)
ACTS = (
    f"list_sort(list_distinct(list_transform({_all('t', V.PROVISION, 0, 'i')}, lambda m: {_ACT})))"
)

# parties
_LINES = (
    f"list_filter(list_transform(string_split({_sub(f'left(t, {V.TITLE_CHARS})', V.MARGIN_LETTER_LINE, _NL)}, "
    f"{_NL}), lambda l: {_strip('l')}), lambda l: l <> '')"
)
_EDGE = f"lower({_strip(_sub('l', V.EDGE_PUNCTUATION))})"
_VERSUS_LIST = ", ".join(_q(v) for v in V.VERSUS)
_IS_VERSUS = (
    f"({_EDGE} IN ({_VERSUS_LIST}) OR l IN ({', '.join(_q(v) for v in V.VERSUS_LINES)}))"
)
_KEPT = (
    f"NOT ({_has('l', V.REPORT_HEADER_LINE, 'i')} OR regexp_matches(l, '^[0-9]+$') "
    f"OR (length(l) <= {V.SHORT_LINE} AND NOT {_IS_VERSUS}))"
)
_SUBJECT = (
    "CASE WHEN regexp_matches(re_line, '[:\\-]') "
    "THEN regexp_extract(re_line, '(?s)^[^:\\-]*[:\\-](.*)$', 1) ELSE re_line END"
)
_P = f"""p0 AS (SELECT *, {_LINES} AS lines FROM j),
  p1 AS (SELECT *,
    {_collapse(f"list_filter(lines[1:{V.IN_RE_LINES}], lambda l: {_has('l', V.IN_RE_LINE, 'i')})[1]")} AS re_line,
    coalesce(list_position(list_transform(lines[1:{V.CASE_LINE_LINES}], lambda l: {_has('l', V.CASE_LINE, 'i')}), true), 0) AS case_at
    FROM p0),
  p2 AS (SELECT *, list_filter(CASE WHEN case_at = 1 THEN [] WHEN case_at > 1 THEN lines[1:case_at - 1]
    ELSE lines[1:{V.TITLE_LINES}] END, lambda l: {_KEPT}) AS block FROM p1),
  p3 AS (SELECT *, coalesce(list_position(list_transform(block, lambda l: {_IS_VERSUS}), true), 0) AS v_at,
    array_to_string(block, ' ') AS joined FROM p2),
  p4 AS (SELECT *,
    CASE WHEN re_line IS NOT NULL THEN {party_name(_SUBJECT)} END AS re_respondent,
    CASE WHEN v_at > 0 THEN {party_name("array_to_string(CASE WHEN v_at > 1 THEN block[1:v_at - 1] ELSE [] END, ' ')")} END AS line_p,
    CASE WHEN v_at > 0 THEN {party_name("array_to_string(block[v_at + 1:], ' ')")} END AS line_r,
    CASE WHEN {_has('joined', V.VERSUS_INLINE, 'i')} THEN {party_name(f"regexp_extract(joined, {_re('^(.*?)' + V.VERSUS_INLINE, 'is')}, 1)")} END AS in_p,
    CASE WHEN {_has('joined', V.VERSUS_INLINE, 'i')} THEN {party_name(f"regexp_extract(joined, {_re('^.*?' + V.VERSUS_INLINE + '(.*)$', 'is')}, 1)")} END AS in_r,
    CASE WHEN len(block) >= 2 THEN {party_name('block[1]')} END AS out_p,
    CASE WHEN len(block) >= 2 THEN {party_name('block[-1]')} END AS out_r FROM p3),
  p5 AS (SELECT *,
    CASE WHEN re_line IS NOT NULL THEN '{V.IN_RE_NAME}' ELSE coalesce(line_p, in_p, out_p) END AS p_all,
    CASE WHEN re_line IS NOT NULL THEN re_respondent WHEN line_p IS NOT NULL THEN line_r
      WHEN in_p IS NOT NULL THEN in_r ELSE out_r END AS r_all FROM p4),
  p AS (SELECT *, nullif(left(p_all, {V.PARTY_MAX}), '') AS petitioner,
    CASE WHEN p_all <> '' THEN nullif(left(r_all, {V.PARTY_MAX}), '') END AS respondent,
    CASE WHEN p_all <> '' THEN left(p_all || ' v. ' || r_all, {V.TITLE_MAX}) END AS title FROM p5)"""


def over_parties(select: str) -> str:
    return f"WITH {_J}, {_P} SELECT {select} FROM p"


# narrative, over n (which knows where the bench ends)
_MARKED = _sub(
    _strip(
        f"regexp_extract(left(t, {V.HEADER_CHARS}), "
        + _re(V.SUMMARY_MARKER.replace("(?=", "(?:"), "is") + ", 1)"
    ),
    V.MARGIN_LETTER_LINE, _NL,
)
_REST = f"substring(left(t, {V.HEADER_CHARS}), bench_end + 1)"
_POST = _collapse(
    _sub(_strip(f"regexp_extract(rest, {_re('^(.*?)' + V.SUMMARY_STOP, 'is')}, 1)"),
         V.MARGIN_LETTER_LINE, _NL)
)
_KW_HIT = _first("t", V.KEYWORD_SECTION, 0, "is")
_KW = (
    f"list_filter(list_transform(string_split({_first('t', V.KEYWORD_SECTION, 1, 'is')}, ';'), "
    f"lambda w: {_collapse('w')}), lambda w: w <> '')"
)
_HN = _collapse(_first("t", V.HEADNOTE_LINE, 1, "i"))
_LINE = f"regexp_extract({_collapse(f'substring(t, bench_end + 1, {V.AFTER_BENCH_CHARS})')}, {_re(V.CATCHLINE)}, 1)"
_LINE_TAGS = (
    "list_filter(list_transform(string_split(line, '-'), lambda w: trim(w, ' .')), lambda w: w <> '')"
)
_MARKED_T = _sub("t", r"(\n[A-Za-z][A-Za-z]+:)", r"concat(chr(1), '\1')")
_HELD = (
    f"regexp_extract_all({_MARKED_T}, '(?im)(?:^|[\\n\\-])[{_SPACE}\\x01]*Held{_WS}*[:,]"
    f"[{_SPACE}\\x01]*([^\\x01]*)', 1)"
)
_HOLDINGS = (
    f"list_transform(list_filter(list_transform({_HELD}, lambda h: {_strip('h')}), "
    f"lambda h: length(h) > {V.HELD_MIN}), lambda h: {_strip(_sub('h', V.PARA_NOTE))})"
)
_RES = f"lower({_first('t', V.RESULT_LINE, 1, 'i')})"
RESULT_LINE = "CASE " + " ".join(
    f"WHEN contains({_RES}, '{w}') THEN '{r}'" for w, r in V.RESULT_WORDS
) + " END"
RESULT_TAIL = "CASE " + " ".join(
    f"WHEN {_has(f'right(t, {V.TAIL_CHARS})', p, 'i')} THEN '{r}'" for _, p, r in V.RESULT_TAIL
) + f" ELSE '{V.RESULT_UNKNOWN}' END"
RESULT = f"coalesce({RESULT_LINE}, {RESULT_TAIL})"
HOLDING = f"CASE WHEN len({_HOLDINGS}) > 0 THEN array_to_string({_HOLDINGS}, {_NL} || {_NL}) END"
SUMMARY_MARKER = (
    f"CASE WHEN length(marked) > {V.SUMMARY_MARKER_MIN} THEN left(marked, {V.SUMMARY_MAX}) END"
)
SUMMARY_POST = (
    f"CASE WHEN {_has('rest', V.SUMMARY_STOP, 'i')} AND length(post) > {V.SUMMARY_POST_BENCH_MIN} "
    f"THEN left({_strip(_sub('post', V.LONE_LETTERS))}, {V.SUMMARY_MAX}) END"
)
TAGS_KW = f"CASE WHEN {_KW_HIT} <> '' THEN {_KW} END"
TAGS_HN = f"CASE WHEN {_HN} <> '' THEN [{_HN}] ELSE [] END"
TAGS_LINE = (
    f"CASE WHEN length(line) > {V.CATCHLINE_LENGTH[0]} AND length(line) < {V.CATCHLINE_LENGTH[1]} "
    f"AND contains(line, '-') AND len({_LINE_TAGS}) BETWEEN {V.CATCHLINE_TAGS[0]} AND {V.CATCHLINE_TAGS[1]} "
    f"THEN {_LINE_TAGS} ELSE [] END"
)
_M = f"""m0 AS (SELECT *, {_MARKED} AS marked, {_REST} AS rest, coalesce({_LINE}, '') AS line FROM n),
  m1 AS (SELECT *, {_POST} AS post, {TAGS_KW} AS tags_kw, {TAGS_HN} AS tags_hn, {TAGS_LINE} AS tags_line FROM m0),
  m AS (SELECT *, {SUMMARY_MARKER} AS sum_marker, {SUMMARY_POST} AS sum_post,
    CASE WHEN tags_kw IS NOT NULL THEN tags_kw WHEN len(tags_hn) > 0 THEN tags_hn ELSE tags_line END AS tags FROM m1)"""


def over_narrative(select: str) -> str:
    return f"WITH {_J}, {_N}, {_M} SELECT {select} FROM m"


# the full record
RECORDS = f"""{_J}, {_Q}, {_C}, {_N}, {_P}, {_M}, rec AS (
  SELECT q.key, q.key_year, q.t AS full_text, q.content_hash, q.quality_score,
    c.case_type, c.case_number, c.judgment_date, c.year, m.bench, {APPLICABILITY} AS applicability,
    p.petitioner, p.respondent, p.title, m.tags, coalesce(m.sum_marker, m.sum_post) AS summary,
    x.acts_cited, x.cases_cited, x.result, x.holding
  FROM q JOIN c ON q.key = c.key JOIN m ON q.key = m.key JOIN p ON q.key = p.key
  JOIN (SELECT key, {ACTS} AS acts_cited, {CITES} AS cases_cited, {RESULT} AS result,
    {HOLDING} AS holding FROM j) x ON q.key = x.key)"""
RECORD_COLUMNS = (
    f"key, title, full_text, case_number, case_type, year, judgment_date, {_joined('bench')} AS bench, "
    f"petitioner, respondent, result, {_joined('acts_cited')} AS acts_cited, "
    f"{_joined('cases_cited')} AS cases_cited, {_joined('tags')} AS tags, summary, holding, "
    "applicability, content_hash, quality_score"
)


def over_records(select: str) -> str:
    return f"WITH {RECORDS} SELECT {select} FROM rec"
