"""Gate, dedup, log, coverage and cross-check on small hand-made tables."""

import re
from datetime import datetime

from pyspark.sql import functions as F

from benchbook import schema
from benchbook.functions import fixed_values as V
from benchbook.operators import coverage, crosscheck, dedup, log, record
from benchbook.sources import keys, pages

DAY = [datetime(2024, 1, d) for d in range(1, 10)]


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def scored(spark, *items):
    return spark.createDataFrame(list(items), "key string, content_hash string, quality_score double")


def test_status_of_each_document(spark):
    batch = scored(
        spark, ("c", "h1", 0.9), ("b", "h1", 0.25), ("a", "h1", 0.2), ("d", "h2", 0.9),
        ("e", None, None), ("f", "h3", 0.0),
    )
    stored = spark.createDataFrame([("h2",), ("h9",)], "content_hash string")
    assert rows(dedup.ingest_status(batch, stored).select("key", "status")) == [
        ("a", "low_quality"), ("b", "done"), ("c", "duplicate"), ("d", "duplicate"),
        ("e", "error"), ("f", "low_quality"),
    ]


def test_insert_if_absent(spark):
    batch = scored(spark, ("b", "h1", 1.0), ("a", "h1", 1.0), ("c", "h2", 1.0))
    none = spark.createDataFrame([], "content_hash string")
    new = dedup.insert_if_absent(batch, none)
    assert rows(new.select("key")) == [("a",), ("c",)]
    assert dedup.insert_if_absent(batch, new).count() == 0
    assert dedup.insert_if_absent(batch.limit(0), none).count() == 0


def test_one_hash_for_most_documents(spark):
    """A hash shared by most rows is reduced before the shuffle, never one task's load."""
    many = spark.range(0, 60000, 1, 8).select(
        F.format_string("k%06d", "id").alias("key"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("content_hash"),
        F.lit(1.0).alias("quality_score"),
    )
    none = spark.createDataFrame([], "content_hash string")
    counts = dict(rows(log.status_counts(dedup.ingest_status(many, none))))
    assert counts == {"done": 20001, "duplicate": 39999}
    plan = dedup.first_of_each_hash(many)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min") > plan.index("Exchange")


def test_small_load_does_not_shuffle_the_store(spark, tmp_path):
    """Hashes and log entries of a large store are scanned against a broadcast load."""
    spark.range(200000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("content_hash"),
        F.col("id").cast("string").alias("key"), F.lit("done").alias("status"),
        F.lit("s3").alias("source"), F.lit(None).cast("string").alias("error_msg"),
        F.current_timestamp().alias("processed_at"),
    ).write.parquet(str(tmp_path / "big"))
    big = spark.read.parquet(str(tmp_path / "big"))
    small = spark.range(3).select(
        F.sha2(F.col("id").cast("string"), 256).alias("content_hash"),
        F.col("id").cast("string").alias("key"),
    )
    for result in (dedup.absent(small, big), log.not_done(small, big)):
        assert result.count() == 0
        plan = result._jdf.queryExecution().executedPlan().toString()
        semi = [line for line in plan.splitlines() if "LeftSemi" in line]
        assert semi and all("BroadcastHashJoin" in line for line in semi)


def test_sample_is_cut_before_the_shuffle(spark):
    plan = keys.sample_keys_per_year(_listing(spark), 2, [1996])._jdf.queryExecution()
    shown = plan.executedPlan().toString()
    assert shown.rindex("WindowGroupLimit") > shown.index("Exchange hashpartitioning(position")


def test_latest_state(spark):
    entries = spark.createDataFrame(
        [
            ("s3", "a", "error", "broken", DAY[0]), ("web", "a", "done", None, DAY[2]),
            ("s3", "b", "done", None, DAY[1]), ("s3", "b", "error", "late", DAY[3]),
            ("s3", "c", "pending", None, DAY[0]),
        ],
        "source string, key string, status string, error_msg string, processed_at timestamp",
    )
    assert rows(log.latest_state(entries).select("key", "source", "status")) == [
        ("a", "s3", "done"), ("b", "s3", "error"), ("c", "s3", "pending"),
    ]
    assert dict(rows(log.latest_state(entries).select("key", "error_msg"))) == {
        "a": None, "b": "late", "c": None,
    }
    assert rows(log.done_keys(entries)) == [("a",)]
    assert rows(log.retry_candidates(entries).select("key")) == [("b",), ("c",)]
    listed = spark.createDataFrame([("a",), ("b",), ("z",)], "key string")
    assert rows(log.not_done(listed, entries)) == [("b",), ("z",)]


def test_equal_times_give_one_answer(spark):
    """Two entries of one time: the larger load, then the entry itself, as a whole row."""
    entries = [
        ("b", "k", "error", "boom", DAY[1], "one"), ("a", "k", "done", None, DAY[1], "two"),
        ("c", "k", "done", "x", DAY[1], "one"), ("d", "j", "done", None, DAY[0], "one"),
        (None, "j", "error", "e", DAY[0], "one"),
    ]
    kinds = "source string, key string, status string, error_msg string, processed_at timestamp, batch_id string"
    for order in (entries, entries[::-1]):
        for parts in (1, 2, 3, 4):
            df = spark.createDataFrame(order, kinds).repartition(parts)
            found = {r["key"]: tuple(r)[1:4] for r in log.latest_state(df).collect()}
            assert found == {"k": ("a", "done", None), "j": ("d", "error", "e")}
            # in two steps, as compact copies are merged
            halves = [log.merged_state(df.filter(F.col("status") == s)) for s in ("done", "error")]
            assert {r["key"]: tuple(r)[1:4] for r in log.merged_state(halves[0].union(halves[1])).collect()} == found


def test_cross_check_takes_the_newest_version(spark):
    """A key that was stored twice: the later load counts, not the smaller hash."""
    row = ("t", "n", 1950, "", ["x"], "Unknown", 0.5)
    kinds = ("title string, case_number string, year int, judgment_date string, bench array<string>, "
             "result string, quality_score double")
    stored = spark.createDataFrame(
        [(*row, "k", "h1", DAY[0], "10"), ("new", *row[1:], "k", "h2", DAY[1], "9")],
        kinds + ", pdf_s3_key string, content_hash string, loaded_at timestamp, batch_id string",
    )
    keys_ = spark.createDataFrame([("k",)], "key string")
    assert crosscheck.cross_check(keys_, stored.repartition(3)).first()["title"] == "new"
    fresh = spark.createDataFrame([(*row, "k")], kinds + ", pdf_s3_key string")
    assert crosscheck.cross_check_diff(fresh, stored).first()["differing"] == ["title"]


def test_copies_are_one_row_in_the_anti_join(spark):
    """The build side of the join with the store is distinct: copies are no hot key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = spark.range(40_000).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("content_hash")
        )
        stored = spark.createDataFrame([("hot",), ("1",)], "content_hash string")
        plan = dedup.absent(many, stored)
        text = plan._jdf.queryExecution().executedPlan().toString()
        semi = text[text.index("LeftSemi"):]
        assert "Aggregate" in semi and plan.filter("content_hash = 'hot'").count() == 0
        assert plan.count() == 40_000 - 13_334 - 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_limit_takes_whole_years_without_a_sort(spark):
    listing = spark.range(0, 20_000, 1, 6).select(
        F.format_string("data/pdf/year=%d/english/%05d.pdf", 1950 + F.col("id") % 7, "id").alias("key"),
        (1950 + F.col("id") % 7).cast("int").alias("year"),
    )
    want = sorted(r.key for r in listing.collect())
    for n in (1, 2857, 2858, 3000, 9000, 19_999, 20_000, 50_000):
        found = keys.limit_keys(listing, n)
        assert sorted(r.key for r in found.collect()) == want[:n]
    plan = keys.limit_keys(listing, 9000)._jdf.queryExecution().optimizedPlan().toString()
    assert int(re.search(r"GlobalLimit (\d+)", plan)[1]) < 2858  # less than one year is sorted


def test_run_summary(spark):
    outcomes = spark.createDataFrame(
        [(s,) for s in ("done", "done", "duplicate", "low_quality", "error", "skipped", "skipped")],
        "status string",
    )
    assert rows(log.run_summary(outcomes)) == [(4, 3, 1, 7)]


def _records(spark, *items):
    return spark.createDataFrame(list(items), schema.RECORD)


def _record(key, **fields):
    return tuple(fields.get(f, [] if f in schema.LIST_FIELDS else key if f == "pdf_s3_key" else None)
                 for f in schema.RECORD.names)


def test_coverage(spark):
    df = _records(
        spark,
        _record("year=1950/a", title="x", bench=["j"], result="Unknown", quality_score=0.0, year=1950),
        _record("year=1950/b", title="", tags=[], quality_score=0.5, year=0),
        _record("year=2000/c", title="y", quality_score=0.5, year=2000),
    )
    found = {r.key: r for r in coverage.fields_populated(df).collect()}
    assert found["year=1950/a"].populated == 4
    assert "quality_score" in found["year=1950/a"].missing
    assert "result" not in found["year=1950/a"].missing
    assert found["year=1950/b"].missing == [f for f in V.REPORT_FIELDS if f != "quality_score"]
    total = {r.field: r for r in coverage.field_coverage(df).collect()}
    assert (total["title"].empty, total["title"].total, total["title"].weak) == (1, 3, True)
    assert (total["holding"].empty, total["holding"].percent) == (3, 100.0)
    year = F.regexp_extract("pdf_s3_key", r"year=(\d+)", 1).cast("int")
    by_year = {(r.key_year, r.field): r for r in coverage.field_coverage_by_year(df, year).collect()}
    assert by_year[1950, "title"].percent == 50.0 and not by_year[2000, "title"].weak
    none = coverage.field_coverage(df.limit(0)).collect()
    assert [r.field for r in none] == list(V.REPORT_FIELDS)
    assert all((r.empty, r.total, r.percent, r.weak) == (0, 0, 0.0, False) for r in none)


def test_cross_check(spark):
    stored = _records(
        spark,
        _record("a", title="A v. B", year=1950, bench=["j"], result="Allowed", content_hash="h1"),
        _record("b", title="", case_number="", judgment_date="", result="", content_hash="h2"),
    )
    keys_ = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    assert rows(crosscheck.cross_check(keys_, stored).select("key", "state")) == [
        ("a", "IN DB"), ("b", "IN DB"), ("c", "NOT IN DB"),
    ]
    fresh = _records(
        spark,
        _record("a", title="A v. C", year=None, bench=["j", "k"], result="Allowed",
                case_number="1", judgment_date="x", content_hash="h1"),
        _record("b", content_hash="h2"),
        _record("c", content_hash="h3"),
    )
    assert dict(rows(crosscheck.cross_check_diff(fresh, stored))) == {
        "a": ["title", "case_number", "year", "judgment_date", "bench"], "b": [],
    }


def test_lookups(spark):
    stored = _records(spark, *[_record(f"d/2024_{i}_EN.pdf", title=str(i)) for i in (11, 12, 22)])
    assert crosscheck.lookup_by_suffix(stored, "3_EN.pdf").count() == 0
    assert [r.title for r in crosscheck.lookup_by_suffix(stored, "4_2__EN.pdf").collect()] == ["22"]
    assert [r.title for r in crosscheck.lookup_by_suffix(stored, "_2_EN.pdf").collect()] == ["12"]
    assert [r.title for r in crosscheck.lookup_by_key(stored, "d/2024_22_EN.pdf").collect()] == ["22"]


def _listing(spark):
    names = [
        (1996, "english/a.pdf"), (1996, "english/b.txt"), (1996, "english/c.PDF"),
        (1996, "hindi/d.pdf"), (1997, "english/e.pdf"), (1997, "english/f.pdf"),
    ]
    return spark.createDataFrame(
        [(f"data/pdf/year={y}/{n}", y) for y, n in names], "key string, year int"
    ).repartition(3)


def _names(df):
    return [r.key.rsplit("/", 1)[1] for r in df.collect()]


def test_listing(spark):
    listing = _listing(spark)
    assert sorted(_names(keys.list_pdf_keys(listing))) == ["a.pdf", "c.PDF", "d.pdf", "e.pdf", "f.pdf"]
    first = keys.list_pdf_keys(listing, max_keys=3, years=[1997, 1996])
    assert sorted(_names(first)) == ["a.pdf", "e.pdf", "f.pdf"]
    assert len(_names(keys.list_pdf_keys(listing, max_keys=0, years=[1996, 1996]))) == 4
    # b.txt takes one of the two places and is dropped afterwards
    assert _names(keys.sample_keys_per_year(listing, 2, [1996])) == ["a.pdf"]
    assert keys.parse_years("2010-2012") == [2010, 2011, 2012]
    assert keys.parse_years("2010, 2012,") == [2010, 2012]
    assert keys.parse_years("2010-2012", 1999) == [1999]
    assert (keys.parse_years()[0], keys.parse_years()[-1]) == (1950, 2025)


def test_pages(spark):
    source = spark.createDataFrame(
        [
            ("a", 2, "  second \n"), ("a", 10, "tenth"), ("a", 1, "REPORTABLE first " + "x" * 60),
            ("b", 1, None), ("b", 2, "text"), ("c", 1, "\n12\n"),
        ],
        schema.PAGES,
    ).repartition(4)
    assert dict(rows(pages.assemble_pages(source))) == {
        "a": "first " + "x" * 60 + "\nsecond\ntenth", "b": None, "c": "12",
    }
    assert rows(pages.scanned_pages(source)) == [("a", 2, 6), ("a", 10, 5), ("b", 2, 4), ("c", 1, 2)]
    assert rows(pages.scanned_share(source))[0] == ("a", 3, 2, 2 / 3)


def test_filter_on_score_does_not_repeat_the_work(spark):
    texts = spark.createDataFrame([("k", "some text")], "key string, full_text string")
    plan = record.with_quality(texts).filter("quality_score >= 0.25").select("key")
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert shown.count("RLIKE") <= 1


def test_provenance(spark):
    df = spark.createDataFrame([("data/x.pdf",)], "key string")
    assert rows(record.with_provenance(df, "https://e", "b")) == [
        ("data/x.pdf", "data/x.pdf", "https://e/b/data/x.pdf")
    ]
