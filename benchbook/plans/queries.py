"""The registered queries: one per operator, each over the whole given tables.

Lists are shown joined by `` | `` so that results of different engines compare as text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchbook.functions import bench, caseline, citations, narrative, normalize, parties, quality
from benchbook.functions import fixed_values as V
from benchbook.functions.regex import collapse, folded
from benchbook.operators import coverage, crosscheck, dedup, log, record, store
from benchbook.plans import check_sql as S
from benchbook.plans import corpus
from benchbook.plans.ingest import (
    LOST, ingest, ingest_objects, ingest_pages, ingest_recognised,
)
from benchbook.session import fresh_folder, local_path, once_per_session, remove, stage
from benchbook.sources import keys, objects, pages
from benchbook.sources.texts import spread
from benchbook.streaming.ingest import read_documents, stream_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if check:
            CHECKS[name] = check
        return run

    return register


def _join(c: Column | str) -> Column:
    return F.array_join(c, " | ")


# ---- inputs ----------------------------------------------------------------------------


@once_per_session
def _clean_column() -> Column:
    return normalize.clean_text(F.col("raw_text")).alias("full_text")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, key_year, full_text``."""
    return corpus.raw_judgments(spark, sf_dir).select("key", "key_year", _clean_column())


@once_per_session
def _window_columns() -> dict[str, Column]:
    body = F.col("full_text")
    return {
        "low": folded(F.col("_lower")),
        "header": normalize.collapsed_header(body),
        "span": bench.bench_span(body),
        "lines": normalize.header_lines(body),
    }


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with the shared steps every derived field starts from."""
    return record.with_lower(texts(spark, sf_dir)).withColumns(_window_columns())


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record.with_quality(texts(spark, sf_dir)).select(
        "key", "key_year", "content_hash", "quality_score"
    )


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record.extract_record(texts(spark, sf_dir))


def _text() -> Column:
    return F.col("full_text")


def _low() -> Column:
    return F.col("low")


def _end() -> Column:
    return F.col("span")["end"]


def field_query(name: str, check: str, **columns: Callable[[], Column]) -> None:
    """Register a query that shows column functions of each text."""

    @once_per_session
    def made() -> list[Column]:
        return [make().alias(c) for c, make in columns.items()]

    @query(name, check)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _windows(spark, sf_dir).select("key", *made())


# ---- sources ---------------------------------------------------------------------------

_KEYS = (
    f"keys AS (SELECT {corpus.ORDER_KEY} AS key, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders)"
)
_ENGLISH = "key LIKE 'data/pdf/year=' || year || '/english/%'"
_PDF = "lower(key) LIKE '%.pdf'"


@query("list_keys", f"WITH {_KEYS} SELECT key, year FROM keys WHERE key LIKE 'data/pdf/%'")
def list_keys(spark, sf_dir):
    return keys.keys_under(corpus.listing(spark, sf_dir))


@query(
    "year_pruned_scan",
    f"WITH {_KEYS} SELECT key, year FROM keys WHERE year IN (1996, 1999) AND {_ENGLISH}",
)
def year_pruned_scan(spark, sf_dir):
    return keys.keys_in_years(corpus.listing(spark, sf_dir), [1996, 1999]).select("key", "year")


@query("pdf_suffix_filter", f"WITH {_KEYS} SELECT key, year FROM keys WHERE {_PDF}")
def pdf_suffix_filter(spark, sf_dir):
    return keys.pdf_keys(corpus.listing(spark, sf_dir))


@query(
    "limit_keys",
    f"WITH {_KEYS} SELECT key, year FROM keys WHERE year IN (1999, 1996) AND {_ENGLISH} AND {_PDF} "
    "ORDER BY CASE year WHEN 1999 THEN 0 ELSE 1 END, key LIMIT 1700",
)
def limit_keys(spark, sf_dir):
    return keys.list_pdf_keys(corpus.listing(spark, sf_dir), max_keys=1700, years=[1999, 1996])


@query(
    "sample_keys_per_year",
    f"WITH {_KEYS}, r AS (SELECT key, year, row_number() OVER (PARTITION BY year ORDER BY key) AS rank "
    f"FROM keys WHERE {_ENGLISH}) SELECT key, year, rank FROM r WHERE rank <= 9 AND {_PDF}",
)
def sample_keys_per_year(spark, sf_dir):
    years = keys.parse_years("1995-2001")
    sampled = keys.sample_keys_per_year(corpus.listing(spark, sf_dir), 9, years)
    return sampled.withColumn("rank", F.col("rank").cast("long"))


@query(
    "year_selection",
    f"WITH {_KEYS} SELECT year, count(*) AS n_keys FROM keys WHERE year BETWEEN 1996 AND 1998 "
    f"AND {_ENGLISH} GROUP BY year",
)
def year_selection(spark, sf_dir):
    chosen = keys.keys_in_years(corpus.listing(spark, sf_dir), keys.parse_years("1996-1998"))
    return chosen.groupBy("year").agg(F.count("*").alias("n_keys"))


@query(
    "union_prefixes",
    f"WITH {_KEYS}, asked(position, year) AS (VALUES (0, 1997), (1, 1996), (2, 1997)) "
    f"SELECT key, keys.year, position FROM keys JOIN asked ON keys.year = asked.year "
    f"WHERE key LIKE 'data/pdf/year=' || keys.year || '/english/%'",
)
def union_prefixes(spark, sf_dir):
    chosen = keys.keys_in_years(corpus.listing(spark, sf_dir), [1997, 1996, 1997])
    return chosen.select("key", "year", "position")


@query(
    "listed_key_count",
    f"WITH {_KEYS} SELECT count(*) AS n_keys FROM keys WHERE {_PDF} AND key LIKE 'data/pdf/%'",
)
def listed_key_count(spark, sf_dir):
    listed = keys.list_pdf_keys(corpus.listing(spark, sf_dir))
    return listed.agg(F.count("*").alias("n_keys"))


@query(
    "read_objects",
    "SELECT page_id, strlen(html) + 1 AS length, sha256(html || chr(10)) AS content_hash FROM pages",
)
def read_objects(spark, sf_dir):
    """Every page of html as an object of its own (with a line end), read back whole."""
    root = fresh_folder(spark, "objects")
    html = corpus.table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("value"))
    if folder := local_path(spark, root):
        some = F.concat(F.lit("some="), F.pmod("page_id", F.lit(256)).cast("string"))
        name = F.concat(F.lit("page_id="), F.col("page_id").cast("string"))
        objects.write_objects(
            html.select(some.alias("folder"), name.alias("name"), "value"), folder, together=True
        )
    else:
        html.write.partitionBy("page_id").text(root)
    found = objects.read_objects(spark, root, "*.txt")
    return found.select(
        F.regexp_extract("path", "/page_id=([0-9]+)[/-]", 1).cast("long").alias("page_id"),
        "length",
        F.sha2("content", 256).alias("content_hash"),
    )


def _object_tree(judgments: DataFrame, root: str) -> None:
    """Every raw judgment as an object of its own (with a line end) in the folder of its year."""
    rows = spread(judgments.select(F.col("raw_text").alias("value"), F.col("key_year").alias("year")))
    top = f"{root}/{V.KEY_ROOT}"
    if folder := local_path(rows.sparkSession, top):
        year = F.coalesce(F.col("year").cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
        objects.write_objects(
            rows.select(
                F.concat(F.lit("year="), year).alias("folder"),
                F.hex(F.xxhash64("value")).alias("name"), "value",
            ),
            folder,
        )
    else:
        rows.write.mode("append").option("maxRecordsPerFile", 1).partitionBy("year").text(top)


@query(
    "list_object_tree",
    f"WITH {S._RAW} SELECT key_year AS year, count(*) AS n_objects, "
    "sum(strlen(raw_text) + 1)::BIGINT AS n_bytes FROM raw WHERE key_year IN (1957, 1960, 1999) "
    "GROUP BY key_year",
)
def list_object_tree(spark, sf_dir):
    """Objects of three years, one of them asked twice, and of a year that has none."""
    root = fresh_folder(spark, "tree")
    _object_tree(corpus.raw_judgments(spark, sf_dir), root)
    listed = keys.list_objects(spark, root, [1999, 1957, 1960, 1957, 2040])
    return listed.groupBy("year").agg(
        F.count("*").alias("n_objects"), F.sum("length").alias("n_bytes")
    )


@query(
    "refresh_inventory",
    f"WITH {S._RAW}, c AS (SELECT key_year AS year, CASE WHEN key_year % 9 = 2 THEN 'gone' "
    "WHEN key_year % 4 = 1 THEN 'added' END AS change FROM raw "
    "WHERE key_year BETWEEN 1960 AND 2010) "
    "SELECT year, change, count(*) AS n FROM c WHERE change IS NOT NULL GROUP BY ALL",
)
def refresh_inventory(spark, sf_dir):
    """What changed in the asked years between two listings of one store."""
    root = fresh_folder(spark, "tree")
    judgments, asked = corpus.raw_judgments(spark, sf_dir), keys.parse_years("1960-2010")
    late = (F.col("key_year") % 4 == 1) & (F.col("key_year") % 9 != 2)
    _object_tree(judgments.filter(~late), root)
    listed = keys.list_objects(spark, root, asked)
    keys.refresh_inventory(spark, listed, f"{root}/store", asked)
    for year in asked:
        if year % 9 == 2:
            remove(spark, f"{root}/{V.KEY_ROOT}year={year}")
    _object_tree(judgments.filter(late), root)
    listed = keys.list_objects(spark, root, asked)
    changes = keys.refresh_inventory(spark, listed, f"{root}/store", asked)
    return changes.groupBy("year", "change").agg(F.count("*").alias("n"))


_LINES_OF = f"string_split(raw_text, {corpus.NL})"
_PAGE = (
    f"array_to_string(lines[p * {corpus.PAGE_LINES} + 1 : p * {corpus.PAGE_LINES} + {corpus.PAGE_LINES}], "
    f"{corpus.NL})"
)
_PAGES = (
    f"{S._RAW}, l AS (SELECT key, {_LINES_OF} AS lines FROM raw), pages AS (SELECT key, "
    f"list_transform(range(0, (len(lines) - 1) // {corpus.PAGE_LINES} + 1), "
    f"lambda p: {S._strip(_PAGE)}) AS texts FROM l)"
)


@query(
    "assemble_pages",
    f"WITH {_PAGES} SELECT key, {S.clean(f'array_to_string(texts, {corpus.NL})')} AS full_text FROM pages",
)
def assemble_pages(spark, sf_dir):
    return pages.assemble_pages(corpus.pages(spark, sf_dir))


@query(
    "scanned_page_candidates",
    f"WITH {_PAGES}, u AS (SELECT key, unnest(texts) AS text, unnest(range(1, len(texts) + 1)) AS page_no "
    f"FROM pages) SELECT key, page_no, length(text) AS n_chars FROM u "
    f"WHERE length(text) < {V.SCANNED_PAGE_CHARS}",
)
def scanned_page_candidates(spark, sf_dir):
    found = pages.scanned_pages(corpus.pages(spark, sf_dir))
    return found.select("key", F.col("page_no").cast("long"), F.col("n_chars").cast("long"))


@query(
    "scanned_page_share",
    f"WITH {_PAGES}, u AS (SELECT key, unnest(texts) AS text FROM pages) "
    f"SELECT key, count(*) AS pages, count(*) FILTER (length(text) < {V.SCANNED_PAGE_CHARS}) AS scanned_pages, "
    f"count(*) FILTER (length(text) < {V.SCANNED_PAGE_CHARS})::DOUBLE / count(*) AS scanned_share "
    f"FROM u GROUP BY key",
)
def scanned_page_share(spark, sf_dir):
    return pages.scanned_share(corpus.pages(spark, sf_dir))


# ---- the log ---------------------------------------------------------------------------

_EVENTS = """log AS (SELECT concat('s', cast(event_id % 3 AS string)) AS source,
  cast(user_id AS string) AS key,
  CASE WHEN event_type = 'purchase' THEN 'done' ELSE event_type END AS status,
  CASE WHEN event_type = 'error' THEN props END AS error_msg, ts AS processed_at FROM events),
latest AS (SELECT key, min({'t': processed_at, 's': source}).s AS source,
  max({'t': processed_at, 's': status, 'm': error_msg}).s AS status,
  arg_max_null(error_msg, {'t': processed_at, 's': status}) AS error_msg,
  max(processed_at) AS processed_at FROM log GROUP BY key)"""
_TIME = "strftime(processed_at, '%Y-%m-%d %H:%M:%S.%f') AS processed_at"


def _timed(df: DataFrame) -> DataFrame:
    return df.withColumn("processed_at", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("upsert_log", f"WITH {_EVENTS} SELECT key, source, status, error_msg, {_TIME} FROM latest")
def upsert_log(spark, sf_dir):
    return _timed(log.latest_state(corpus.events_log(spark, sf_dir)))


@query("done_keys", f"WITH {_EVENTS} SELECT key FROM latest WHERE status = 'done'")
def done_keys(spark, sf_dir):
    return log.done_keys(corpus.events_log(spark, sf_dir))


@query("done_key_count", f"WITH {_EVENTS} SELECT count(*) AS n_keys FROM latest WHERE status = 'done'")
def done_key_count(spark, sf_dir):
    return log.done_keys(corpus.events_log(spark, sf_dir)).agg(F.count("*").alias("n_keys"))


@query(
    "retry_candidates",
    f"WITH {_EVENTS} SELECT key, source, status, error_msg, {_TIME} FROM latest WHERE status <> 'done'",
)
def retry_candidates(spark, sf_dir):
    return _timed(log.retry_candidates(corpus.events_log(spark, sf_dir)))


@query(
    "resume_anti_join",
    f"WITH {_EVENTS} SELECT cast(c_custkey AS string) AS key, c_name FROM customer "
    "WHERE cast(c_custkey AS string) NOT IN (SELECT key FROM latest WHERE status = 'done')",
)
def resume_anti_join(spark, sf_dir):
    listed = corpus.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("key"), "c_name"
    )
    return log.not_done(listed, corpus.events_log(spark, sf_dir))


_OUTCOME = (
    "CASE event_type WHEN 'purchase' THEN 'done' WHEN 'view' THEN 'duplicate' "
    "WHEN 'click' THEN 'low_quality' WHEN 'signup' THEN 'skipped' ELSE event_type END"
)


@query(
    "run_summary",
    f"WITH o AS (SELECT {_OUTCOME} AS status FROM events) SELECT "
    "count(*) FILTER (status IN ('done', 'duplicate', 'low_quality')) AS stored, "
    "count(*) FILTER (status IN ('skipped', 'error')) AS skipped, "
    "count(*) FILTER (status = 'error') AS logged_errors, count(*) AS processed FROM o",
)
def run_summary(spark, sf_dir):
    return log.run_summary(
        corpus.table(spark, sf_dir, "events").select(F.expr(_OUTCOME).alias("status"))
    )


@query(
    "status_counts",
    f"SELECT {_OUTCOME} AS status, count(*) AS n FROM events GROUP BY 1",
)
def status_counts(spark, sf_dir):
    return log.status_counts(
        corpus.table(spark, sf_dir, "events").select(F.expr(_OUTCOME).alias("status"))
    )


# ---- text normalisation ------------------------------------------------------------------


@query("clean_text", S.over_text("key, t AS full_text"))
def clean_text(spark, sf_dir):
    return texts(spark, sf_dir).select("key", "full_text")


_PARTY_OF_CUSTOMER = corpus.party_names("c_custkey", "c_name")


@query(
    "clean_party_name",
    f"SELECT c_custkey, {S.party_name(_PARTY_OF_CUSTOMER)} AS party FROM customer",
)
def clean_party_name(spark, sf_dir):
    df = corpus.table(spark, sf_dir, "customer")
    party = normalize.clean_party_name(F.expr(_PARTY_OF_CUSTOMER))
    return df.select("c_custkey", party.alias("party"))


_ACT_OF_PART = corpus.act_names("p_partkey", "p_name")


@query("canonical_act_name", f"SELECT p_partkey, {S.act_name(_ACT_OF_PART)} AS act FROM part")
def canonical_act_name(spark, sf_dir):
    df = corpus.table(spark, sf_dir, "part")
    return df.select(
        "p_partkey", normalize.canonical_act_name(F.expr(_ACT_OF_PART)).alias("act")
    )


field_query(
    "collapse_space",
    S.over_text(f"key, {S._collapse('t')} AS collapsed"),
    collapsed=lambda: collapse(_text()),
)
field_query(
    "margin_letter_lines",
    S.over_text(f"key, {S._sub('t', V.MARGIN_LETTER_LINE, S._NL)} AS text"),
    text=lambda: normalize.drop_margin_letters(_text()),
)
field_query(
    "margin_prefix_strip",
    S.over_text(f"key, {S._strip(S._sub('t', V.LONE_LETTERS))} AS text"),
    text=lambda: normalize.strip_lone_letters(_text()),
)
field_query(
    "header_windows",
    S.over_text(
        f"key, {S._HEADER} AS header, left(t, {V.BENCH_CHARS}) AS bench_window, "
        f"left(t, {V.TITLE_CHARS}) AS title_window, right(t, {V.TAIL_CHARS}) AS tail_window"
    ),
    header=lambda: F.col("header"),
    bench_window=lambda: normalize.head(_text(), V.BENCH_CHARS),
    title_window=lambda: normalize.head(_text(), V.TITLE_CHARS),
    tail_window=lambda: F.right(_text(), F.lit(V.TAIL_CHARS)),
)

# ---- quality ---------------------------------------------------------------------------

field_query(
    "word_count",
    S.over_text(f"key, {S.WORDS} AS words"),
    words=lambda: quality.word_count(_text()).cast("long"),
)
field_query(
    "alpha_ratio", S.over_text(f"key, {S.ALPHA} AS ratio"), ratio=lambda: quality.alpha_ratio(_text())
)
field_query(
    "legal_keyword_hits",
    S.over_text(f"key, {S.HITS} AS hits"),
    hits=lambda: quality.legal_word_hits(F.col("_lower")).cast("long"),
)
field_query(
    "content_hash",
    S.over_text("key, sha256(t) AS content_hash"),
    content_hash=lambda: quality.content_hash(_text()),
)


@query("quality_score", S.over_quality("key, quality_score"))
def quality_score(spark, sf_dir):
    return _scored(spark, sf_dir).select("key", "quality_score")


@query(
    "quality_gate",
    S.over_quality("key, quality_score") + f" WHERE quality_score >= {V.MIN_QUALITY}",
)
def quality_gate(spark, sf_dir):
    return dedup.quality_gate(_scored(spark, sf_dir)).select("key", "quality_score")


@query(
    "low_quality_docs",
    S.over_quality("key, key_year, quality_score") + f" WHERE quality_score < {V.MIN_QUALITY}",
)
def low_quality_docs(spark, sf_dir):
    return dedup.low_quality(_scored(spark, sf_dir)).select("key", "key_year", "quality_score")


# ---- case line, date, year ---------------------------------------------------------------

field_query(
    "extract_case_number",
    S.over_case("key, case_type, case_number, case_year"),
    case_type=lambda: caseline.case_line(F.col("header"))["case_type"],
    case_number=lambda: caseline.case_line(F.col("header"))["case_number"],
    case_year=lambda: caseline.case_line(F.col("header"))["case_year"],
)
field_query(
    "extract_judgment_date",
    S.over_case("key, judgment_date"),
    judgment_date=lambda: caseline.judgment_date(F.col("header")),
)
field_query(
    "resolve_year",
    S.over_case("key, year"),
    year=lambda: caseline.resolved_year(
        caseline.judgment_date(F.col("header")),
        F.col("key"),
        caseline.case_line(F.col("header"))["case_year"],
    ),
)

# ---- bench -----------------------------------------------------------------------------

field_query(
    "locate_bench_span",
    S.over_bench("key, bench_raw, bench_end"),
    bench_raw=lambda: F.col("span")["raw"],
    bench_end=lambda: _end().cast("long"),
)
field_query(
    "extract_bench",
    S.over_bench(f"key, {S._joined('bench')} AS bench, len(bench)::BIGINT AS judges"),
    bench=lambda: _join(bench.bench_names(_text(), F.col("span"))),
    judges=lambda: F.size(bench.bench_names(_text(), F.col("span"))).cast("long"),
)
field_query(
    "extract_applicability",
    S.over_bench(f"key, {S.APPLICABILITY} AS applicability"),
    applicability=lambda: bench.applicability(bench.bench_names(_text(), F.col("span"))),
)

# ---- citations and statutes ----------------------------------------------------------------


def _cites_query(kind: str) -> None:
    field_query(
        f"extract_cites_{kind}",
        S.over_text(f"key, {S._joined(S.cites_of_kind(kind))} AS cites"),
        cites=lambda: _join(citations.cites_of_kind(_text(), _low(), kind)),
    )


for _kind in V.CITATIONS:
    _cites_query(_kind)
field_query(
    "extract_citations",
    S.over_text(f"key, {S._joined(S.CITES)} AS cases_cited"),
    cases_cited=lambda: _join(citations.cases_cited(_text(), _low())),
)
field_query(
    "extract_acts",
    S.over_text(f"key, {S._joined(S.ACTS)} AS acts_cited"),
    acts_cited=lambda: _join(citations.acts_cited(_text(), _low())),
)

# ---- parties ---------------------------------------------------------------------------


def _block() -> Column:
    return parties.title_block(F.col("lines"))


def _sides_query(name: str, petitioner: str, respondent: str, make: Callable[[], Column]) -> None:
    @query(name, S.over_parties(f"key, {petitioner} AS petitioner, {respondent} AS respondent"))
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = _windows(spark, sf_dir).select("key", parties.cleaned(make()).alias("sides"))
        return found.select("key", "sides.petitioner", "sides.respondent")


field_query(
    "title_block",
    S.over_parties(f"key, {S._joined('block')} AS block"),
    block=lambda: _join(_block()),
)
_sides_query(
    "extract_title_in_re",
    f"CASE WHEN re_line IS NOT NULL THEN '{V.IN_RE_NAME}' END",
    "re_respondent",
    lambda: parties.in_re(F.col("lines")),
)
_sides_query(
    "extract_parties_versus_line", "line_p", "line_r", lambda: parties.versus_line(_block())
)
_sides_query(
    "extract_parties_inline", "in_p", "in_r", lambda: parties.versus_inline(_block())
)
_sides_query(
    "extract_parties_fallback", "out_p", "out_r", lambda: parties.outer_lines(_block())
)


@query("extract_parties", S.over_parties("key, petitioner, respondent, title"))
def extract_parties(spark, sf_dir):
    sides = F.col("sides")
    found = _windows(spark, sf_dir).select("key", parties.sides(F.col("lines")).alias("sides"))
    return found.select(
        "key",
        parties.petitioner(sides).alias("petitioner"),
        parties.respondent(sides).alias("respondent"),
        parties.title(sides).alias("title"),
    )


# ---- narrative -------------------------------------------------------------------------

field_query(
    "extract_summary_marker",
    S.over_narrative("key, sum_marker AS summary"),
    summary=lambda: narrative.summary_from_marker(_text(), _low()),
)
field_query(
    "extract_summary_post_bench",
    S.over_narrative("key, sum_post AS summary"),
    summary=lambda: narrative.summary_after_bench(_text(), _end()),
)
field_query(
    "extract_summary",
    S.over_narrative("key, coalesce(sum_marker, sum_post) AS summary"),
    summary=lambda: narrative.summary(_text(), _low(), _end()),
)
field_query(
    "extract_tags_keywords",
    S.over_narrative(f"key, {S._joined('tags_kw')} AS tags"),
    tags=lambda: _join(narrative.tags_from_keywords(_text(), _low())),
)
field_query(
    "extract_tags_headnote",
    S.over_narrative(f"key, {S._joined('tags_hn')} AS tags"),
    tags=lambda: _join(narrative.tags_from_headnote(_text(), _low())),
)
field_query(
    "extract_tags_catchline",
    S.over_narrative(f"key, {S._joined('tags_line')} AS tags"),
    tags=lambda: F.coalesce(_join(narrative.tags_from_catchline(_text(), _end())), F.lit("")),
)
field_query(
    "extract_tags",
    S.over_narrative(f"key, {S._joined('tags')} AS tags"),
    tags=lambda: _join(narrative.tags(_text(), _low(), _end())),
)
field_query(
    "extract_holding",
    S.over_text(f"key, {S.HOLDING} AS holding"),
    holding=lambda: narrative.holding(_text(), _low()),
)
field_query(
    "detect_result_structured",
    S.over_text(f"key, {S.RESULT_LINE} AS result"),
    result=lambda: narrative.result_from_line(_text(), _low()),
)
field_query(
    "detect_result_fallback",
    S.over_text(f"key, {S.RESULT_TAIL} AS result"),
    result=lambda: narrative.result_from_tail(_text()),
)
field_query(
    "detect_result",
    S.over_text(f"key, {S.RESULT} AS result"),
    result=lambda: narrative.result(_text(), _low()),
)

# ---- records ---------------------------------------------------------------------------


def _shown(records: DataFrame) -> DataFrame:
    """Records with lists joined and the object key first."""
    lists = [f.name for f in records.schema if isinstance(f.dataType, T.ArrayType)]
    return records.withColumns({c: _join(c) for c in lists}).withColumnRenamed("pdf_s3_key", "key")


@query("extract_record", S.over_records(S.RECORD_COLUMNS))
def extract_record(spark, sf_dir):
    return _shown(_records(spark, sf_dir))


_ENDPOINT, _BUCKET = "https://objects.example.org", "judgments"


@query(
    "with_provenance",
    f"WITH {S._RAW} SELECT key AS pdf_s3_key, '{_ENDPOINT}/{_BUCKET}/' || key AS source_url FROM raw",
)
def with_provenance(spark, sf_dir):
    listed = corpus.raw_judgments(spark, sf_dir)
    return record.with_provenance(listed, _ENDPOINT, _BUCKET).select("pdf_s3_key", "source_url")


# ---- store and dedup ---------------------------------------------------------------------

_OLD = f"(SELECT content_hash FROM q WHERE quality_score >= {V.MIN_QUALITY} AND key_year < 1985)"
_WINNERS = (
    f"SELECT content_hash, min(key) AS key FROM q WHERE quality_score >= {V.MIN_QUALITY} "
    f"AND content_hash NOT IN {_OLD} GROUP BY content_hash"
)


def _scored_and_old(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every scored judgment, and the hashes a store of the years before 1985 would hold."""
    scored = stage(_scored(spark, sf_dir), "scored")
    old = dedup.quality_gate(scored.filter("key_year < 1985"))
    return scored, old.select("content_hash").distinct()


@query("insert_if_absent", f"WITH {S._J}, {S._Q} {_WINNERS}")
def insert_if_absent(spark, sf_dir):
    scored, old = _scored_and_old(spark, sf_dir)
    return dedup.insert_if_absent(dedup.quality_gate(scored), old).select("content_hash", "key")


@query("inserted_count", f"WITH {S._J}, {S._Q}, w AS ({_WINNERS}) SELECT count(*) AS inserted FROM w")
def inserted_count(spark, sf_dir):
    return insert_if_absent(spark, sf_dir).agg(F.count("*").alias("inserted"))


@query(
    "dedup_anti_join",
    f"WITH {S._J}, {S._Q} SELECT key, content_hash FROM q WHERE content_hash NOT IN {_OLD}",
)
def dedup_anti_join(spark, sf_dir):
    scored, old = _scored_and_old(spark, sf_dir)
    return dedup.absent(scored, old).select("key", "content_hash")


_STATUS = (
    f"CASE WHEN quality_score < {V.MIN_QUALITY} THEN '{V.LOW_QUALITY}' "
    f"WHEN key IN (SELECT key FROM w) THEN '{V.DONE}' ELSE '{V.DUPLICATE}' END"
)


@query(
    "ingest_status",
    f"WITH {S._J}, {S._Q}, w AS ({_WINNERS}) SELECT key, {_STATUS} AS status FROM q",
)
def ingest_status(spark, sf_dir):
    scored, old = _scored_and_old(spark, sf_dir)
    return dedup.ingest_status(scored, old).select("key", "status")


@query(
    "mirror_raw",
    f"WITH {S._RAW} SELECT key, key_year AS year, strlen(raw_text) AS n_bytes, "
    "sha256(raw_text) AS content_hash FROM raw",
)
def mirror_raw(spark, sf_dir):
    root = fresh_folder(spark, "mirror")
    source = corpus.raw_judgments(spark, sf_dir).select(
        "key", F.col("key_year").alias("year"), F.encode("raw_text", "UTF-8").alias("content")
    )
    objects.mirror_raw(source, root, "one")
    return objects.read_mirror(spark, root).select(
        "key",
        "year",
        F.octet_length("content").cast("long").alias("n_bytes"),
        F.sha2("content", 256).alias("content_hash"),
    )


@query("init_store", f"WITH {_EVENTS} SELECT status, count(*) AS n FROM log GROUP BY status")
def init_store(spark, sf_dir):
    """Setting up an existing store again leaves its rows alone."""
    root = fresh_folder(spark, "store")
    store.init_store(spark, root)
    store.append_log(corpus.events_log(spark, sf_dir), root, "one")
    store.init_store(spark, root)
    return log.status_counts(store.read_table(spark, root, "ingest_log"))


_FIRST_RUN = (
    f"SELECT content_hash, min(key) AS key FROM q WHERE quality_score >= {V.MIN_QUALITY} "
    "GROUP BY content_hash"
)


@query(
    "ingest_batch",
    f"WITH {S.RECORDS}, w AS ({_FIRST_RUN}) SELECT {S.RECORD_COLUMNS} FROM ("
    "SELECT rec.* REPLACE (" + ", ".join(
        f"coalesce({c}, '') AS {c}"
        for c in (
            "title", "case_number", "case_type", "judgment_date", "petitioner", "respondent",
            "summary", "holding", "applicability",
        )
    ) + ") FROM rec JOIN w ON rec.key = w.key)",
)
def ingest_batch(spark, sf_dir):
    """A whole load into an empty store, read back."""
    root = fresh_folder(spark, "store")
    ingest(texts(spark, sf_dir).select("key", "full_text"), root, "one")
    stored = store.read_table(spark, root, "judgments").drop("source_url", "batch_id", "loaded_at")
    return _shown(stored)


_READABLE = f"SELECT * FROM q WHERE key_year % 3 > 0 AND quality_score >= {V.MIN_QUALITY}"
_DAMAGED_STATUS = (
    f"CASE WHEN key_year % 3 = 0 THEN '{V.ERROR}' ELSE {_STATUS} END AS status, "
    "CASE WHEN key_year % 3 = 0 THEN 'document has no readable text' END AS error_msg"
)
_DAMAGED = (
    f"WITH {S._J}, {S._Q}, w AS (SELECT min(key) AS key FROM ({_READABLE}) GROUP BY content_hash) "
)


def _damaged(df: DataFrame, text: str) -> DataFrame:
    readable = keys.key_year(F.col("key")) % 3 > 0
    return df.withColumn(text, F.when(readable, F.col(text)))


@query(
    "error_capture",
    f"{_DAMAGED}, o AS (SELECT key, content_hash, {_DAMAGED_STATUS} FROM q) "
    "SELECT o.key, status, error_msg, "
    f"CASE WHEN status = '{V.DONE}' THEN content_hash END AS stored_hash FROM o",
)
def error_capture(spark, sf_dir):
    """A third of the documents cannot be read; the load logs them, stores the rest, goes on."""
    root = fresh_folder(spark, "store")
    ingest(_damaged(texts(spark, sf_dir), "full_text"), root, "one")
    stored = store.read_table(spark, root, "judgments").select(
        F.col("pdf_s3_key").alias("key"), F.col("content_hash").alias("stored_hash")
    )
    logged = store.read_table(spark, root, "ingest_log").select("key", "status", "error_msg")
    return logged.join(stored, "key", "left")


@query(
    "unreadable_objects",
    f"WITH {S._J}, {S._Q}, o AS (SELECT key_year AS year, CASE WHEN key_year % 5 IN (1, 3) "
    f"THEN '{V.ERROR}' WHEN quality_score < {V.MIN_QUALITY} THEN '{V.LOW_QUALITY}' "
    f"ELSE '{V.DONE}' END AS status, CASE key_year % 5 WHEN 1 THEN '{LOST}' "
    "WHEN 3 THEN 'object has # of # bytes' END AS error_msg FROM q) "
    "SELECT year, status, error_msg, count(*) AS n FROM o GROUP BY ALL",
)
def unreadable_objects(spark, sf_dir):
    """Objects that vanish or shrink between listing and load are logged, all others loaded.

    Names of objects are not told by the tables, so copies are shown with what they are copies of.
    """
    root = fresh_folder(spark, "tree")
    _object_tree(corpus.raw_judgments(spark, sf_dir), root)
    listed = stage(keys.list_objects(spark, root), "listing")
    for year in keys.parse_years("1950-2025"):
        if year % 5 == 1:
            remove(spark, f"{root}/{V.KEY_ROOT}year={year}")
    shrunk = F.when(F.col("year") % 5 == 3, 7).otherwise(0)
    listed = listed.withColumn("length", F.col("length") + shrunk)
    outcome = ingest_objects(listed, root, f"{root}/store", "one")
    status = F.when(F.col("status") == V.DUPLICATE, V.DONE).otherwise(F.col("status"))
    return outcome.groupBy(
        keys.key_year(F.col("key")).alias("year"), status.alias("status"),
        F.regexp_replace("error_msg", "[0-9]+", "#").alias("error_msg"),
    ).agg(F.count("*").alias("n"))


@query(
    "load_into_a_store",
    f"WITH {S._J}, {S._Q}, old AS (SELECT content_hash FROM q WHERE key_year % 10 > 0 "
    f"AND quality_score >= {V.MIN_QUALITY}), new AS (SELECT * FROM q WHERE key_year % 10 = 0), "
    f"w AS (SELECT min(key) AS key FROM new WHERE quality_score >= {V.MIN_QUALITY} "
    "AND content_hash NOT IN (SELECT content_hash FROM old) GROUP BY content_hash) "
    f"SELECT key, CASE WHEN quality_score < {V.MIN_QUALITY} THEN '{V.LOW_QUALITY}' "
    f"WHEN key IN (SELECT key FROM w) THEN '{V.DONE}' ELSE '{V.DUPLICATE}' END AS status FROM new",
)
def load_into_a_store(spark, sf_dir):
    """A smaller load after a larger one: it reads the folders of its own hashes and keys."""
    root = fresh_folder(spark, "store")
    documents, late = texts(spark, sf_dir), F.col("key_year") % 10 == 0
    ingest(documents.filter(~late).select("key", "full_text"), root, "one")
    outcome = ingest(documents.filter(late).select("key", "full_text"), root, "two")
    return outcome.select("key", "status")


@query(
    "run_totals",
    f"WITH {S._J}, {S._Q}, w AS ({_FIRST_RUN}), o AS (SELECT {_STATUS} AS status FROM q), "
    f"runs AS (SELECT 'first' AS run, status FROM o UNION ALL "
    f"SELECT 'second', CASE status WHEN '{V.DONE}' THEN 'skipped' ELSE status END FROM o) "
    f"SELECT run, count(*) FILTER (status NOT IN ('skipped', '{V.ERROR}')) AS stored, "
    f"count(*) FILTER (status IN ('skipped', '{V.ERROR}')) AS skipped, "
    f"count(*) FILTER (status = '{V.ERROR}') AS logged_errors, count(*) AS processed "
    "FROM runs GROUP BY run",
)
def run_totals(spark, sf_dir):
    """The counters of a load and of the same load run again: what was done is skipped."""
    root = fresh_folder(spark, "store")
    documents = texts(spark, sf_dir).select("key", "full_text")
    totals = [
        log.run_summary(ingest(documents, root, name)).withColumn("run", F.lit(name))
        for name in ("first", "second")
    ]
    return totals[0].union(totals[1])


@query(
    "ingest_from_pages",
    f"WITH {_PAGES}, j AS (SELECT key, {S.clean(f'array_to_string(texts, {corpus.NL})')} AS t "
    f"FROM pages) SELECT DISTINCT sha256(t) AS content_hash FROM j WHERE key IN "
    f"(SELECT key FROM (WITH {S._J}, {S._Q} SELECT key FROM q WHERE quality_score >= {V.MIN_QUALITY}))",
)
def ingest_from_pages(spark, sf_dir):
    """A load that starts from pages; every second year was loaded before and is skipped."""
    root = fresh_folder(spark, "store")
    found = corpus.pages(spark, sf_dir)
    ingest_pages(found.filter(keys.key_year(F.col("key")) % 2 == 0), root, "one")
    ingest_pages(found, root, "two")
    return store.read_table(spark, root, "judgments").select("content_hash")


_RECOGNISED = (
    "concat('  Recognised page ', page_no, ' of ', key, ': the appeal of the petitioner is held good. ')"
)


@query(
    "recognised_pages",
    f"WITH {_PAGES}, u AS (SELECT key, unnest(texts) AS text, unnest(range(1, len(texts) + 1)) AS page_no "
    f"FROM pages), s AS (SELECT *, length(text) < {V.SCANNED_PAGE_CHARS} AND page_no % 3 > 0 AS taken "
    "FROM u), j AS (SELECT key, "
    f"CAST(regexp_extract(key, 'year=([0-9]+)', 1) AS INTEGER) AS key_year, "
    + S.clean(
        f"string_agg(CASE WHEN taken THEN {_RECOGNISED} ELSE text END, {corpus.NL} ORDER BY page_no)"
    )
    + f" AS t FROM s GROUP BY key HAVING bool_or(taken)), {S._Q}, "
    f"w AS (SELECT min(key) AS key FROM q WHERE quality_score >= {V.MIN_QUALITY} GROUP BY content_hash) "
    f"SELECT key, CASE WHEN quality_score < {V.MIN_QUALITY} THEN '{V.LOW_QUALITY}' "
    f"WHEN key IN (SELECT key FROM w) THEN '{V.DONE}' ELSE '{V.DUPLICATE}' END AS status, "
    f"CASE WHEN quality_score >= {V.MIN_QUALITY} AND key IN (SELECT key FROM w) THEN content_hash END "
    "AS content_hash FROM q",
)
def recognised_pages(spark, sf_dir):
    """Two thirds of the scanned pages are recognised after the load: new versions of their texts."""
    root = fresh_folder(spark, "store")
    found = corpus.pages(spark, sf_dir)
    ingest_pages(found, root, "one")
    new = pages.scanned_pages(found).filter("page_no % 3 > 0").select(
        "key", "page_no", F.expr(_RECOGNISED).alias("page_text")
    )
    outcome = ingest_recognised(new, found, root, "two")
    current = store.current_judgments(store.read_table(spark, root, "judgments"))
    hashes = current.filter("batch_id = 'two'").select(
        F.col("pdf_s3_key").alias("key"), "content_hash"
    )
    return outcome.select("key", "status").join(hashes, "key", "left")


# ---- the store read again ----------------------------------------------------------------


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The judgments of a store that all texts were loaded into."""
    root = fresh_folder(spark, "store")
    ingest(texts(spark, sf_dir).select("key", "full_text"), root, "one")
    return store.read_table(spark, root, "judgments")


def _stored_sql(columns: str, rest: str = "") -> str:
    """Columns of the stored rows; NULL texts are stored empty."""
    shown = ", ".join(
        f"coalesce({c}, '') AS {c}"
        for c in ("title", "case_number", "judgment_date", "summary", "holding", "applicability")
    )
    return (
        f"WITH {S.RECORDS}, s AS ({_FIRST_RUN}), w AS (SELECT rec.* REPLACE ({shown}) FROM rec "
        f"JOIN s ON rec.key = s.key) SELECT {columns} FROM w {rest}"
    )


@query(
    "reparse_stored",
    S.over_records(f"key, title, {S._joined('tags')} AS tags, summary, holding, applicability")
    + f" WHERE key IN (SELECT key FROM ({_FIRST_RUN}))",
)
def reparse_stored(spark, sf_dir):
    again = record.reparse(_loaded(spark, sf_dir)).select(
        "pdf_s3_key", "title", "tags", "summary", "holding", "applicability"
    )
    return _shown(again)


@query(
    "reextract_stored",
    _stored_sql(f"key, title, {S._joined('tags')} AS tags, summary, holding, applicability"),
)
def reextract_stored(spark, sf_dir):
    """A store whose fields come from older rules, brought up to the newest ones, load by load."""
    root = fresh_folder(spark, "store")
    ingest(texts(spark, sf_dir).select("key", "full_text"), root, "one")
    older = store.read_table(spark, root, "judgments").withColumns(
        {"title": F.lit("older"), "tags": F.array(F.lit("older")), "holding": F.lit("")}
    )
    older = stage(older.drop("batch_id"), "older")
    older.write.mode("overwrite").parquet(f"{root}/judgments/batch_id=one")
    store.reextract(spark, root, record.EXTRACTOR + 1)
    again = store.read_table(spark, root, "judgments").select(
        "pdf_s3_key", "title", "tags", "summary", "holding", "applicability"
    )
    return _shown(again)


@query(
    "lookup_by_suffix",
    _stored_sql("key, title, year", "WHERE key LIKE '%000_7_EN.pdf' ORDER BY key LIMIT 1"),
)
def lookup_by_suffix(spark, sf_dir):
    found = crosscheck.lookup_by_suffix(_loaded(spark, sf_dir), "000_7_EN.pdf")
    return _shown(found.select("pdf_s3_key", "title", "year"))


_ONE_KEY = "data/pdf/year=1957/english/000000007_EN.pdf"


@query(
    "lookup_by_key",
    _stored_sql(
        f"key, title, case_number, year, judgment_date, {S._joined('bench')} AS bench, result, "
        "quality_score",
        f"WHERE key = '{_ONE_KEY}'",
    ),
)
def lookup_by_key(spark, sf_dir):
    return _shown(crosscheck.lookup_by_key(_loaded(spark, sf_dir), _ONE_KEY))


# ---- coverage and cross-check --------------------------------------------------------------


def _empty_sql(field: str) -> str:
    if field in ("bench", "acts_cited", "cases_cited", "tags"):
        return f"(len({field}) = 0)"
    if field in ("year", "quality_score"):
        return f"({field} IS NULL OR {field} = 0)"
    return f"({field} IS NULL OR {field} = '')"


_EMPTY_ROWS = ", e AS (" + " UNION ALL ".join(
    f"SELECT key, key_year, '{f}' AS field, {i} AS pos, {_empty_sql(f)} AS is_empty FROM rec"
    for i, f in enumerate(V.REPORT_FIELDS)
) + ")"
_COVERAGE = (
    "field, count(*) FILTER (is_empty) AS empty, count(*) AS total, "
    "count(*) FILTER (is_empty)::DOUBLE / count(*) * 100 AS percent, "
    f"count(*) FILTER (is_empty)::DOUBLE / count(*) * 100 >= {V.WEAK_FIELD_PERCENT} AS weak"
)


@query("field_is_empty", f"WITH {S.RECORDS}{_EMPTY_ROWS} SELECT key, field, is_empty FROM e")
def field_is_empty(spark, sf_dir):
    records = _records(spark, sf_dir)
    wide = records.select(
        F.col("pdf_s3_key").alias("key"),
        *[coverage.is_empty(records, f).alias(f) for f in V.REPORT_FIELDS],
    )
    return wide.unpivot(["key"], list(V.REPORT_FIELDS), "field", "is_empty")


@query(
    "fields_populated",
    f"WITH {S.RECORDS}{_EMPTY_ROWS} SELECT key, count(*) FILTER (NOT is_empty) AS populated, "
    "coalesce(string_agg(field, ' | ' ORDER BY pos) FILTER (is_empty), '') AS missing FROM e GROUP BY key",
)
def fields_populated(spark, sf_dir):
    found = coverage.fields_populated(_records(spark, sf_dir))
    return found.select("key", F.col("populated").cast("long"), _join("missing").alias("missing"))


@query("field_coverage", f"WITH {S.RECORDS}{_EMPTY_ROWS} SELECT {_COVERAGE} FROM e GROUP BY field")
def field_coverage(spark, sf_dir):
    return coverage.field_coverage(_records(spark, sf_dir))


@query(
    "field_coverage_by_year",
    f"WITH {S.RECORDS}{_EMPTY_ROWS} SELECT key_year, {_COVERAGE} FROM e GROUP BY key_year, field",
)
def field_coverage_by_year(spark, sf_dir):
    return coverage.field_coverage_by_year(
        _records(spark, sf_dir), keys.key_year(F.col("pdf_s3_key"))
    )


_STORED_CHECKED = ", ".join(f"w.{c}" for c in crosscheck.STORED_FIELDS if c != "bench")


@query(
    "cross_check",
    f"WITH {S.RECORDS}, s AS ({_FIRST_RUN}), w AS (SELECT rec.* FROM rec JOIN s ON rec.key = s.key) "
    f"SELECT rec.key, CASE WHEN w.key IS NULL THEN 'NOT IN DB' ELSE 'IN DB' END AS state, "
    f"{_STORED_CHECKED}, CASE WHEN w.key IS NOT NULL THEN {S._joined('w.bench')} END AS bench "
    "FROM rec LEFT JOIN w ON rec.key = w.key",
)
def cross_check(spark, sf_dir):
    records = stage(_records(spark, sf_dir).drop("full_text"), "records").withColumn(
        "key", F.col("pdf_s3_key")
    )
    stored = dedup.insert_if_absent(
        dedup.quality_gate(records), records.select("content_hash").limit(0)
    )
    return _shown(crosscheck.cross_check(records.select("key"), stored))


@query(
    "cross_check_diff",
    f"WITH {S.RECORDS} SELECT key, concat_ws(' | ', "
    "CASE WHEN year % 2 = 0 THEN 'year' END, "
    "CASE WHEN result <> 'Unknown' AND key_year % 5 = 0 THEN 'result' END, "
    "CASE WHEN quality_score >= 0.5 THEN 'quality_score' END) AS differing FROM rec",
)
def cross_check_diff(spark, sf_dir):
    """Fresh results against an older state of the same rows."""
    records = stage(_records(spark, sf_dir).drop("full_text"), "records")
    older = records.withColumns(
        {
            **{c: F.coalesce(c, F.lit("")) for c in ("title", "case_number", "judgment_date")},
            "year": F.when(F.col("year") % 2 == 0, F.col("year") + 1).otherwise(F.col("year")),
            "result": F.when(
                keys.key_year(F.col("pdf_s3_key")) % 5 == 0, F.lit(V.RESULT_UNKNOWN)
            ).otherwise(F.col("result")),
            "quality_score": F.when(F.col("quality_score") >= 0.5, F.lit(0.25)).otherwise(
                F.col("quality_score")
            ),
        }
    )
    found = crosscheck.cross_check_diff(records, older)
    return found.select("key", _join("differing").alias("differing"))


@query(
    "changed_rows",
    f"WITH {S.RECORDS} SELECT key, concat_ws(' | ', "
    "CASE WHEN key_year = 1961 THEN 'year' END, "
    "CASE WHEN key_year IN (1961, 1999) AND quality_score >= 0.5 THEN 'quality_score' END) AS differing "
    "FROM rec WHERE key_year = 1961 OR key_year = 1999 AND quality_score >= 0.5",
)
def changed_rows(spark, sf_dir):
    """Fresh results against a store in which two years are older; the rest is told by digests."""
    records = stage(_records(spark, sf_dir).drop("full_text"), "records")
    year = keys.key_year(F.col("pdf_s3_key"))
    older = records.withColumns(
        {
            **{c: F.coalesce(c, F.lit("")) for c in ("title", "case_number", "judgment_date")},
            "year": F.when(year == 1961, F.coalesce("year", F.lit(0)) + 1).otherwise(F.col("year")),
            "quality_score": F.when(
                year.isin(1961, 1999) & (F.col("quality_score") >= 0.5), F.lit(0.25)
            ).otherwise(F.col("quality_score")),
        }
    )
    found = crosscheck.changed_rows(records, older)
    return found.select("key", _join("differing").alias("differing"))


_GOOD = f"quality_score >= {V.MIN_QUALITY}"


@query(
    "coverage_of_loads",
    f"WITH {S.RECORDS}, earlier AS (SELECT content_hash, min(key) AS key FROM q WHERE {_GOOD} "
    f"AND key_year % 2 = 0 GROUP BY 1), later AS (SELECT content_hash, min(key) AS key FROM q "
    f"WHERE {_GOOD} AND key_year % 2 = 1 AND content_hash NOT IN (SELECT content_hash FROM earlier) GROUP BY 1), "
    "s AS (FROM earlier UNION ALL FROM later)" + _EMPTY_ROWS + ", "
    "shown AS (SELECT field, key_year, is_empty FROM e JOIN s ON e.key = s.key) "
    f"SELECT key_year, grouping(key_year) = 1 AS every_year, {_COVERAGE} FROM shown "
    "GROUP BY GROUPING SETS ((field), (field, key_year))",
)
def coverage_of_loads(spark, sf_dir):
    """Two loads, each counted once, and their report for every year and for all."""
    root = fresh_folder(spark, "store")
    documents = texts(spark, sf_dir)
    for n in (0, 1):
        part = documents.filter(F.col("key_year") % 2 == n).select("key", "full_text")
        ingest(part, root, f"load{n}")
        coverage.count_loads(spark, root)
    return coverage.coverage_of_loads(spark, root)


# ---- streaming -------------------------------------------------------------------------


STREAMED_FILES = 4


def _prepare(batch: DataFrame) -> DataFrame:
    return batch.select(
        F.expr(corpus.JUDGMENT_KEY).alias("key"),
        normalize.clean_text(F.expr(corpus.RAW_TEXT)).alias("full_text"),
    )


def _run_stream(spark: SparkSession, sf_dir: str, root: str, name: str) -> None:
    """Stream the whole documents table into the store, once."""
    schema = corpus.table(spark, sf_dir, "documents").schema
    # a pattern, so that the table may be one file as well as a folder of files
    source = read_documents(spark, f"{sf_dir}/document[s].parquet", schema)
    stream_ingest(source, _prepare, root, f"{root}/checkpoint-{name}").awaitTermination()


_RUN_ONE = f"WITH {S._J}, {S._Q}, w AS ({_FIRST_RUN}), o AS (SELECT key, content_hash, {_STATUS} AS status FROM q)"


@query(
    "stream_ingest",
    f"{_RUN_ONE} SELECT DISTINCT content_hash FROM o WHERE status IN ('{V.DONE}', '{V.DUPLICATE}')",
)
def stream_ingest_query(spark, sf_dir):
    root = fresh_folder(spark, "stream")
    _run_stream(spark, sf_dir, root, "a")
    return store.read_table(spark, root, "judgments").select("content_hash")


@query(
    "stream_resume",
    f"{_RUN_ONE}, t AS (SELECT status, CASE status WHEN '{V.DONE}' THEN 1 ELSE 2 END AS tries FROM o) "
    "SELECT status, sum(tries)::BIGINT AS n FROM t GROUP BY status",
)
def stream_resume(spark, sf_dir):
    """Everything is offered twice: finished keys are skipped, the others tried again."""
    root = fresh_folder(spark, "stream")
    for name in ("a", "b"):
        _run_stream(spark, sf_dir, root, name)
    return log.status_counts(store.read_table(spark, root, "ingest_log"))


@query(
    "stream_dedup",
    f"{_RUN_ONE} SELECT count(*) AS n_rows, count(DISTINCT content_hash) AS n_hashes FROM o "
    f"WHERE status = '{V.DONE}'",
)
def stream_dedup(spark, sf_dir):
    root = fresh_folder(spark, "stream")
    for name in ("a", "b"):
        _run_stream(spark, sf_dir, root, name)
    return store.read_table(spark, root, "judgments").agg(
        F.count("*").alias("n_rows"), F.countDistinct("content_hash").alias("n_hashes")
    )


@query(
    "stream_many_files",
    f"{_RUN_ONE} SELECT DISTINCT content_hash FROM o WHERE status IN ('{V.DONE}', '{V.DUPLICATE}')",
)
def stream_many_files(spark, sf_dir):
    """The documents as several files, each a micro-batch and a load of its own."""
    root = fresh_folder(spark, "stream")
    documents = corpus.table(spark, sf_dir, "documents")
    documents.repartition(STREAMED_FILES, "doc_id").write.parquet(f"{root}/in")
    source = read_documents(spark, f"{root}/in", documents.schema, max_files=1)
    stream_ingest(source, _prepare, root, f"{root}/checkpoint").awaitTermination()
    return store.read_table(spark, root, "judgments").select("content_hash")
