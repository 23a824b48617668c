"""Whole loads: batch, repeated, interrupted, streamed; files as sources and sinks."""

import hashlib
import uuid
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from benchbook import schema
from benchbook.functions.normalize import clean_text
from benchbook.operators import coverage, crosscheck, log, record, store
from benchbook.operators.record import extract_record
from benchbook.plans.ingest import (
    LOST, ingest, ingest_objects, ingest_pages, ingest_recognised,
)
from benchbook.plans import queries
from benchbook.session import folders_in, remove
from benchbook.sources import keys, objects
from benchbook.sources.texts import read_texts, spread
from benchbook.streaming.ingest import read_documents, stream_ingest

LEGAL = (
    "The judgment in appeal of the petitioner and the respondent was heard by the court under "
    "section 4; the order of the bench, coram present, is held good. "
)


def documents(spark, numbers, parts=3):
    """``key, full_text``; numbers with the same remainder by 10 share a text, 9 is poor."""
    made = []
    for n in numbers:
        kind = n % 10
        text = "1 2 3" if kind == 9 else f"Ram {kind}\nv.\nShyam {kind}\n(Civil Appeal No. {kind} of 19{50 + kind})\n" + LEGAL * 5
        made.append((f"data/pdf/year={1950 + n % 40}/english/{n:05d}.pdf", text))
    return spark.createDataFrame(made, "key string, full_text string").repartition(parts)


def counts(df):
    return dict(tuple(r) for r in log.status_counts(df).collect())


def stored(spark, root):
    return store.read_table(spark, root, "judgments")


def test_load_twice(spark, tmp_path):
    root = str(tmp_path)
    first = ingest(documents(spark, range(30)), root, "one", endpoint="https://e", bucket="b")
    assert counts(first) == {"done": 9, "duplicate": 18, "low_quality": 3}
    rows = stored(spark, root).orderBy("pdf_s3_key").collect()
    assert [r.pdf_s3_key[-9:] for r in rows] == [f"{n:05d}.pdf" for n in range(9)]
    assert rows[1].source_url == "https://e/b/" + rows[1].pdf_s3_key
    assert (rows[1].title, rows[1].year, rows[1].holding) == ("Ram 1 v. Shyam 1", 1951, "")
    # done keys are skipped, all others are tried again and nothing new is stored
    again = ingest(documents(spark, range(30)), root, "two")
    assert counts(again) == {"duplicate": 18, "low_quality": 3, "skipped": 9}
    assert log.run_summary(again).first().asDict() == {
        "stored": 21, "skipped": 9, "logged_errors": 0, "processed": 30,
    }
    settled = ingest(
        documents(spark, range(40)), root, "three", skip=("done", "duplicate", "low_quality")
    )
    assert counts(settled) == {"duplicate": 9, "low_quality": 1, "skipped": 30}
    assert stored(spark, root).count() == 9
    state = log.latest_state(store.read_table(spark, root, "ingest_log"))
    assert counts(state) == {"done": 9, "duplicate": 27, "low_quality": 4}


def test_an_unfinished_load_is_replaced(spark, tmp_path):
    """A load that broke before it wrote its log gives the same result when run again."""
    root = str(tmp_path)
    first = counts(ingest(documents(spark, range(20)), root, "one"))
    remove(spark, f"{root}/ingest_log/batch_id=one")
    assert counts(ingest(documents(spark, range(20), 5), root, "one")) == first
    assert stored(spark, root).count() == 9
    assert store.read_table(spark, root, "ingest_log").count() == 20


def test_a_finished_load_is_kept(spark, tmp_path):
    """Other documents under its name are answered with what it returned, and change nothing."""
    root = str(tmp_path)
    first = ingest(documents(spark, range(5)), root, "one").collect()
    again = ingest(documents(spark, range(5, 9)), root, "one").collect()
    assert sorted(again) == sorted(first)
    kept = sorted(r.pdf_s3_key[-9:] for r in stored(spark, root).collect())
    assert kept == [f"{n:05d}.pdf" for n in range(5)]
    assert counts(ingest(documents(spark, range(5, 9)), root, "two")) == {"done": 4}
    assert stored(spark, root).count() == 9


def test_the_text_that_was_judged_is_stored(spark, tmp_path):
    """Of a key with several texts the smallest hash stands, whatever order they come in."""
    texts = [f"Ram {i}\nv.\nShyam {i}\n" + LEGAL * 5 for i in range(6)]
    rows = [(f"data/pdf/year=1950/english/{k}.pdf", t) for k in range(8) for t in texts[k % 2 :: 2]]
    hashes = [hashlib.sha256(t.encode()).hexdigest() for t in texts]
    for parts in (1, 4):
        root = str(tmp_path / str(parts))
        df = spark.createDataFrame(rows, "key string, full_text string").repartition(parts)
        outcome = counts(ingest(df.union(df), root, "one"))
        assert outcome == {"done": 2, "duplicate": 6}
        found = stored(spark, root).collect()
        assert {r.content_hash for r in found} == {min(hashes[0::2]), min(hashes[1::2])}
        assert all(hashlib.sha256(r.full_text.encode()).hexdigest() == r.content_hash for r in found)


def _pages(spark, numbers):
    rows = []
    for r in documents(spark, numbers).collect():
        lines = r.full_text.split("\n")
        rows += [(r.key, 1, lines[0]), (r.key, 2, "\n".join(lines[1:]))]
    return spark.createDataFrame(rows, "key string, page_no int, page_text string").repartition(4)


def test_load_from_pages(spark, tmp_path):
    root = str(tmp_path)
    pages = _pages(spark, range(12)).withColumn(
        "page_text",
        F.when((F.col("key").endswith("00003.pdf")) & (F.col("page_no") == 2), None)
        .otherwise(F.col("page_text")),
    )
    objects_of = pages.select("key", F.lit(b"raw").alias("content"), F.lit(1950).alias("year"))
    objects_of = objects_of.dropDuplicates(["key"])
    first = ingest_pages(pages, root, "one", objects=objects_of)
    assert counts(first) == {"done": 8, "duplicate": 2, "low_quality": 1, "error": 1}
    assert objects.read_mirror(spark, root).count() == 12
    again = ingest_pages(_pages(spark, range(12)), root, "two", objects=objects_of)
    assert counts(again) == {"done": 1, "skipped": 8, "duplicate": 2, "low_quality": 1}
    mirror = store.read_table(spark, root, "mirror").groupBy("batch_id").count()
    assert {r[0]: r[1] for r in mirror.collect()} == {"one": 12, "two": 4}


def test_recognised_pages_replace_scanned_ones(spark, tmp_path):
    root = str(tmp_path)
    body = [f"Ram {n}\nv.\nShyam {n}\n" + LEGAL * 5 for n in range(4)]
    rows = [(f"data/pdf/year=1950/english/{n}.pdf", p, t) for n in range(4)
            for p, t in ((1, body[n]), (2, "short"), (3, " "))]
    rows += [("nothing", 1, None), ("other", 1, "  " + body[0])]
    pages_of = spark.createDataFrame(rows, schema.PAGES)
    key = rows[0][0]
    first = ingest_pages(pages_of, root, "one")
    assert counts(first) == {"done": 5, "error": 1}

    def recognised(*found):
        kind = "key string, page_no int, page_text string, recognised_at string"
        made = spark.createDataFrame([(*f, "2024-01-01") for f in found], kind)
        return made.withColumn("recognised_at", F.col("recognised_at").cast("timestamp"))

    # a page with a text of its own, an unknown one and a failed one change nothing
    new = recognised((key, 1, "not taken"), ("who", 1, "x"), (rows[3][0], 2, None))
    assert ingest_recognised(new, pages_of, root, "two").count() == 0
    new = recognised((key, 2, "  found 2\n"), ("nothing", 1, body[1] + " more"))
    assert counts(ingest_recognised(new, pages_of, root, "three")) == {"done": 2}
    # a later page of the same document: the earlier one stays in the text; the newest wins
    new = recognised((key, 3, "old"), (key, 3, "young")).withColumn(
        "recognised_at", F.when(F.col("page_text") == "old", F.col("recognised_at")).otherwise(F.now())
    )
    assert counts(ingest_recognised(new, pages_of, root, "four")) == {"done": 1}
    current = {r.pdf_s3_key: r for r in store.current_judgments(stored(spark, root)).collect()}
    assert stored(spark, root).count() == 8 and len(current) == 6
    assert current[key].batch_id == "four"
    want = body[0].strip() + "\n" + "  found 2\n" + "\n" + "young"
    found = spark.createDataFrame([(want,)], "t string").select(clean_text(F.col("t"))).first()[0]
    assert current[key].full_text == found
    assert current["nothing"].full_text.endswith("more")
    again = ingest_recognised(new, pages_of, root, "five")  # nothing new in it
    assert counts(again) == {"duplicate": 1}
    assert store.current_judgments(stored(spark, root)).count() == 6


def _texts_moved(plan):
    """Lines of the plan that exchange, sort or aggregate a text."""
    steps = ("Exchange", "Sort", "Aggregate")
    return [x for x in plan.splitlines() if any(s in x for s in steps) and "full_text" in x]


def _plans(spark, run):
    """The plans of everything that ``run`` writes."""
    writes = []
    writer = DataFrameWriter.parquet

    def seen(self, path, *a, **b):
        writes.append(self._df._jdf.queryExecution().executedPlan().toString())
        return writer(self, path, *a, **b)

    DataFrameWriter.parquet = seen
    try:
        run()
    finally:
        DataFrameWriter.parquet = writer
    return writes


def test_texts_are_read_once_and_not_moved(spark, tmp_path):
    documents(spark, range(30)).write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    plans = _plans(spark, lambda: ingest(source, str(tmp_path / "store"), "one"))
    assert len([p for p in plans if "sha2" in p]) == 1
    assert len([p for p in plans if f"{tmp_path}/in" in p and "full_text" in p]) == 1
    assert not [x for p in plans for x in _texts_moved(p)]


def test_pages_of_done_documents_are_dropped_before_they_are_put_together(spark, tmp_path):
    root = str(tmp_path / "store")
    _pages(spark, range(30)).write.parquet(str(tmp_path / "in"))
    source = spark.read.parquet(str(tmp_path / "in"))
    ingest_pages(source.filter("key < 'data/pdf/year=1960'"), root, "one")
    plan = next(p for p in _plans(spark, lambda: ingest_pages(source, root, "two")) if "sha2" in p)
    lines = plan.splitlines()
    anti = next(i for i, x in enumerate(lines) if "LeftAnti" in x)
    grouped = max(i for i, x in enumerate(lines) if "Aggregate" in x and "page_text" in x)
    assert anti > grouped  # lower in the tree


def test_nothing_is_left_in_the_shared_folder(spark, tmp_path):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.glob("load-*"))
    ingest(documents(spark, range(5)), str(tmp_path / "a"), "one")
    assert set(shared.glob("load-*")) == before
    ingest(documents(spark, range(5)), str(tmp_path / "b"), "one", work=str(tmp_path / "work"))
    assert not (tmp_path / "work").exists()


def test_a_load_reads_a_bounded_number_of_runs(spark, tmp_path):
    """The 30th load reads as many hash and state files as eight runs a level come to."""
    root = str(tmp_path)
    for n in range(30):
        assert counts(ingest(documents(spark, [n], 1), root, f"{n:02d}")) != {}
    for name in ("hashes", "states"):
        levels = [len(folders_in(spark, f"{root}/{name}/level={k}")) for k in range(3)]
        assert levels == [30 % store.FAN, 30 // store.FAN, 0]
        files = list(Path(f"{root}/{name}").rglob("part-*.parquet"))
        assert len(files) <= 2 * (store.FAN - 1) * 4
    plans = _plans(spark, lambda: ingest(documents(spark, [3, 40], 1), root, "30"))
    assert not [p for p in plans if "ingest_log" in p or "judgments" in p]
    assert counts(store.load_outcome(spark, root, "30")) == {"skipped": 1, "duplicate": 1}
    states = log.merged_state(store.read_runs(spark, root, "states"))
    state = log.latest_state(store.read_table(spark, root, "ingest_log"))
    assert counts(states) == counts(state) == {"done": 9, "duplicate": 19, "low_quality": 3}


def _bytes_read(df):
    return sum(Path(p.removeprefix("file:" + "//" * p.startswith("file://"))).stat().st_size for p in df.inputFiles())


def test_a_load_reads_what_it_asks_for(spark, tmp_path, monkeypatch):
    """Ten times the store: a load of the same size reads no more of hashes and states."""
    monkeypatch.setattr(store, "FOLDER_ROWS", 64)
    asked = spark.range(30).select(F.sha2(F.col("id").cast("string"), 256).alias("content_hash"))
    keys_asked = spark.range(30).select(F.format_string("k%d", "id").alias("key"))
    read = {}
    for size in (8_000, 80_000):
        root = str(tmp_path / str(size))
        rows = spark.range(size).select(
            F.sha2(F.col("id").cast("string"), 256).alias("content_hash"),
            F.format_string("k%d", "id").alias("key"), F.lit("s3").alias("source"),
            F.lit("done").alias("status"), F.lit(None).cast("string").alias("error_msg"),
            F.timestamp_seconds("id").alias("processed_at"),
        )
        states = log.merged_state(rows)
        store.write_run(rows.select("content_hash"), root, "hashes", 1, "old", size)
        store.write_run(states, root, "states", 1, "old", size)
        hashes = store.read_runs(spark, root, "hashes", "new", asked)
        known = store.read_runs(spark, root, "states", "new", keys_asked)
        assert hashes.join(asked, "content_hash", "left_semi").count() == 30
        assert known.join(keys_asked, "key", "left_semi").count() == 30
        assert hashes.count() < 30 * 4 * 64 and known.count() < 30 * 4 * 64
        read[size] = _bytes_read(hashes), _bytes_read(known)
        everything = store.read_runs(spark, root, "hashes"), store.read_runs(spark, root, "states")
        assert [df.count() for df in everything] == [size, size]
        total = [_bytes_read(df) for df in everything]
    assert all(b < 1.6 * a for a, b in zip(read[8_000], read[80_000]))
    assert all(b < t / 8 for b, t in zip(read[80_000], total))
    assert store.read_runs(spark, root, "hashes", "old").count() == 0


def test_report_over_loads_reads_no_text(spark, tmp_path):
    root, kinds = str(tmp_path), []
    for n in range(3):
        rows = extract_record(documents(spark, range(3 * n, 3 * n + 3))).withColumn("source_url", F.lit(""))
        store.append_judgments(rows, root, f"l{n}")
        store.append_log(spark.createDataFrame([], schema.INGEST_LOG), root, f"l{n}")
    kinds = _plans(spark, lambda: coverage.count_loads(spark, root))
    assert len(kinds) == 3 and not [p for p in kinds if "full_text" in p]
    assert _plans(spark, lambda: coverage.count_loads(spark, root)) == []  # each load once
    report = coverage.coverage_of_loads(spark, root)
    assert "judgments" not in report._jdf.queryExecution().executedPlan().toString()
    found = {(r.field, r.key_year): (r.empty, r.total, r.weak) for r in report.collect()}
    for year, want in ((None, coverage.field_coverage(stored(spark, root))),):
        assert {r.field: (r.empty, r.total, r.weak) for r in want.collect()} == {
            f: v for (f, y), v in found.items() if y is year
        }
    by_year = coverage.field_coverage_by_year(stored(spark, root), keys.key_year(F.col("pdf_s3_key")))
    assert {(r.field, r.key_year): (r.empty, r.total, r.weak) for r in by_year.collect()} == {
        k: v for k, v in found.items() if k[1] is not None
    }


def test_only_parts_that_changed_are_compared(spark):
    records = extract_record(documents(spark, range(9)))
    rows = store.storable(records.withColumn("source_url", F.lit(""))).withColumn("batch_id", F.lit("a"))
    assert crosscheck.changed_rows(records, rows).collect() == []
    other = rows.withColumn("year", F.when(F.col("title").startswith("Ram 4"), 1).otherwise(F.col("year")))
    (found,) = crosscheck.changed_rows(records, other).collect()
    assert found.key.endswith("00004.pdf") and found.differing == ["year"]
    # a key on one side only, and an older version beside the newest, are no differences
    less = rows.filter(~F.col("title").startswith("Ram 2"))
    assert crosscheck.changed_rows(records, less).collect() == []
    older = other.withColumn("loaded_at", F.col("loaded_at") - F.expr("interval 1 day"))
    assert crosscheck.changed_rows(records, rows.unionByName(older)).collect() == []


def test_runs_in_folders_give_the_same_loads(spark, tmp_path, monkeypatch):
    """Folders of three rows, several loads, merged runs: outcomes are those of one folder."""
    outcomes = {}
    for rows in (3, 10**6):
        monkeypatch.setattr(store, "FOLDER_ROWS", rows)
        monkeypatch.setattr(store, "FAN", 3)
        root = str(tmp_path / str(rows))
        loads = [range(0, 25), range(20, 60), [], range(3, 70), [None], range(5, 9), range(80, 99)]
        for n, numbers in enumerate(loads):
            made = documents(spark, [i for i in numbers if i is not None] or [0], 2)
            made = made.limit(0) if not numbers else made
            if numbers == [None]:
                made = spark.createDataFrame([(None, "x"), ("k", None)], made.schema)
            outcomes.setdefault(n, []).append(sorted(map(str, ingest(made, root, f"l{n}").collect())))
        bits = {b for _, b in store.runs_of(spark, root, "states")}
        assert bits == {0} if rows > 3 else max(bits) > 2
        hashes = store.read_runs(spark, root, "hashes").collect()
        assert sorted(r[0] for r in hashes) == sorted(r.content_hash for r in stored(spark, root).collect())
        state = log.latest_state(store.read_table(spark, root, "ingest_log"))
        assert counts(log.merged_state(store.read_runs(spark, root, "states"))) == counts(state)
    assert all(a == b for a, b in outcomes.values())


def test_a_broken_run_is_not_read(spark, tmp_path):
    root = str(tmp_path)
    ingest(documents(spark, range(9)), root, "one")
    (path, _), = store.runs_of(spark, root, "hashes")
    remove(spark, f"{path}/_SUCCESS")
    assert store.read_runs(spark, root, "hashes").count() == 0


def test_lookup_by_key_before_compaction(spark, tmp_path):
    """Loads whose keys span the asked one are told by Bloom filters not to be decoded."""
    root = str(tmp_path)
    for n in range(3):
        rows = extract_record(documents(spark, range(n, 3000, 3), 1))
        store.append_judgments(rows.withColumn("source_url", F.lit("")), root, f"l{n}")
    key = "data/pdf/year=1967/english/01337.pdf"
    found = crosscheck.lookup_by_key(stored(spark, root), key)
    assert [r.pdf_s3_key for r in found.collect()] == [key]

    def scanned(df):
        df.collect()
        node = df._jdf.queryExecution().executedPlan()
        while node.children().size():
            node = node.children().head()
        return node.metrics().apply("numOutputRows").value()

    assert scanned(found) == 1000  # the one load that has it
    assert scanned(crosscheck.lookup_by_key(stored(spark, root), key + "x")) == 0


def test_compaction_keeps_rows(spark, tmp_path):
    root = str(tmp_path)
    ingest(documents(spark, range(30)), root, "one")
    before = sorted(map(str, stored(spark, root).collect()))
    store.compact(spark, root, "one")
    assert sorted(map(str, stored(spark, root).collect())) == before
    one = crosscheck.lookup_by_key(stored(spark, root), "data/pdf/year=1951/english/00001.pdf")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(pdf_s3_key" in plan and "sha2" not in plan
    again = record.reparse(stored(spark, root))
    assert "sha2" not in again._jdf.queryExecution().executedPlan().toString()
    fresh = extract_record(documents(spark, range(9)))
    assert sorted(again.select("content_hash", "title").collect()) == sorted(
        fresh.select("content_hash", "title").collect()
    )


def test_only_older_loads_are_extracted_anew(spark, tmp_path):
    root = str(tmp_path)
    ingest(documents(spark, range(5)), root, "one", endpoint="https://e", bucket="b")
    before = sorted(map(str, stored(spark, root).collect()))
    assert store.reextract(spark, root) == []  # loads are of the newest version
    remove(spark, f"{root}/extractor")
    assert store.reextract(spark, root, 7) == ["one"]
    assert sorted(map(str, stored(spark, root).collect())) == before
    ingest(documents(spark, range(5, 8)), root, "two")
    remove(spark, f"{root}/ingest_log/batch_id=two")  # not finished: its next attempt writes it
    assert _plans(spark, lambda: store.reextract(spark, root, 7)) == []


def test_key_listed_twice_and_unreadable(spark, tmp_path):
    root = str(tmp_path)
    twice = documents(spark, [1, 2, 2, 9]).union(
        spark.createDataFrame([("bad", None)], "key string, full_text string")
    )
    outcome = ingest(twice, root, "one")
    assert counts(outcome) == {"done": 2, "low_quality": 1, "error": 1}
    assert outcome.filter("key = 'bad'").first().error_msg
    assert stored(spark, root).count() == 2


def test_records_do_not_depend_on_partitions(spark):
    one = extract_record(documents(spark, range(12), 1)).orderBy("pdf_s3_key").collect()
    many = extract_record(documents(spark, range(12), 16)).orderBy("pdf_s3_key").collect()
    assert one == many


def _stream(spark, source, root, checkpoint):
    schema = spark.read.parquet(source).schema
    stream = read_documents(spark, source, schema, max_files=1)
    query = stream_ingest(stream, lambda batch: batch, root, checkpoint)
    query.awaitTermination()
    return query


def test_stream_equals_batch(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "store")
    for start in (0, 12, 24):
        documents(spark, range(start, start + 12), 1).write.mode("append").parquet(source)
    query = _stream(spark, source, root, str(tmp_path / "c1"))
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 3
    batch = ingest(documents(spark, range(36)), str(tmp_path / "batch"), "one")
    streamed = store.read_table(spark, root, "ingest_log")
    assert counts(streamed) == counts(batch)
    hashes = {r.content_hash for r in stored(spark, root).collect()}
    assert hashes == {r.content_hash for r in stored(spark, str(tmp_path / "batch")).collect()}
    assert stored(spark, root).count() == len(hashes)
    # more files: only those are read; a new checkpoint offers all again, done ones are skipped
    documents(spark, range(36, 40), 1).write.mode("append").parquet(source)
    _stream(spark, source, root, str(tmp_path / "c1"))
    assert store.read_table(spark, root, "ingest_log").count() == 40
    _stream(spark, source, root, str(tmp_path / "c2"))
    assert stored(spark, root).count() == len(hashes)
    assert store.read_table(spark, root, "ingest_log").count() == 40 + (40 - len(hashes))


def test_one_row_group_is_work_for_all_cores(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "store")
    documents(spark, range(30), 1).write.parquet(source)
    stream = read_documents(spark, source, spark.read.parquet(source).schema, max_bytes=10**9)
    parts = []

    def prepare(batch):
        parts.append(batch._jdf.queryExecution().toRdd().getNumPartitions())
        return batch

    stream_ingest(stream, prepare, root, str(tmp_path / "c"), parts=3).awaitTermination()
    stream_ingest(stream, prepare, root, str(tmp_path / "d")).awaitTermination()
    assert parts == [3, spark.sparkContext.defaultParallelism]
    assert stored(spark, root).count() == 9
    many = spark.read.parquet(source).repartition(7)
    assert spread(many, 3) is many


def test_micro_batches_are_bounded_by_bytes(spark, tmp_path):
    source = str(tmp_path / "in")
    for start in range(0, 40, 10):
        documents(spark, range(start, start + 10), 1).write.mode("append").parquet(source)
    files = sorted(p.stat().st_size for p in Path(source).glob("part-*.parquet"))
    schema = spark.read.parquet(source).schema
    stream = read_documents(spark, source, schema, max_bytes=files[-1] + files[-2])
    stream_ingest(stream, lambda b: b, str(tmp_path / "s"), str(tmp_path / "c")).awaitTermination()
    loads = store.read_table(spark, str(tmp_path / "s"), "ingest_log").groupBy("batch_id").count()
    assert [r["count"] for r in loads.collect()] == [20, 20]


def _tree(root, numbers):
    """Objects of ``documents`` as files; returns their paths by number."""
    made = {}
    for n in numbers:
        path = root / f"data/pdf/year={1950 + n % 4}/english/{n:05d}.pdf"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(f"Ram {n}\nv.\nShyam {n}\n" + LEGAL * 5)
        made[n] = path
    return made


def test_objects_that_cannot_be_read(spark, tmp_path):
    source, root = tmp_path / "objects", str(tmp_path / "store")
    files = _tree(source, range(16))
    files[3].write_bytes(b"\xff\xfe" + b"judgment " * 60)
    listing = spark.createDataFrame(
        keys.list_objects(spark, str(source)).collect(), "key string, year int, length long, modified timestamp"
    )
    files[0].unlink()
    files[1].write_bytes(files[1].read_bytes()[:100])
    for n in (2, 6, 10, 14):
        files[n].unlink()
    files[2].parent.rmdir()  # a year folder is gone as a whole
    outcome = ingest_objects(listing, str(source), root, "one")
    errors = {int(r.key[-9:-4]): r.error_msg for r in outcome.filter("status = 'error'").collect()}
    lost = dict.fromkeys((0, 2, 6, 10, 14), LOST)
    size = files[4].stat().st_size
    assert errors == lost | {1: f"object has 100 of {size} bytes", 3: "object is not UTF-8 text"}
    assert counts(outcome) == {"done": 9, "error": 7}
    # what was lost is tried again and, once it is back, loaded
    _tree(source, range(16))
    again = ingest_objects(listing.drop("length"), str(source), root, "two")
    assert counts(again) == {"done": 7, "skipped": 9}
    none = ingest_objects(listing.limit(0), str(source), root, "three")
    assert none.count() == 0
    gone = ingest_objects(listing, str(tmp_path / "nowhere"), str(tmp_path / "other"), "one")
    assert counts(gone) == {"error": 16}


def test_inventory(spark, tmp_path):
    source, root = tmp_path / "objects", str(tmp_path / "store")
    files = _tree(source, range(12))
    years = [1950, 1951, 1952, 1953]

    def refresh(asked):
        fresh = keys.list_objects(spark, str(source), asked)
        changes = keys.refresh_inventory(spark, fresh, root, asked).collect()
        return {(int(r.key[-9:-4]), r.change) for r in changes}

    assert refresh(years) == {(n, "added") for n in range(12)}
    assert refresh(years) == set()
    files[0].unlink()
    files[1].write_text("longer " + files[1].read_text())
    for n in (3, 7, 11):
        files[n].unlink()
    _tree(source, [12, 13])
    # only the asked years are listed, compared and written
    assert refresh([1950]) == {(0, "gone"), (12, "added")}
    assert refresh([1951, 1953]) == {(1, "changed"), (13, "added"), (3, "gone"), (7, "gone"), (11, "gone")}
    known = keys.inventory(spark, root)
    assert sorted(int(r.key[-9:-4]) for r in known.collect()) == [1, 2, 4, 5, 6, 8, 9, 10, 12, 13]
    pruned = keys.keys_in_years(known, [1952])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year" in plan
    assert {p.split("/year=")[1][:4] for p in known.filter("year = 1952").inputFiles()} >= {"1952"}
    assert refresh([2024]) == set()


def test_only_asked_years_are_listed(spark, tmp_path):
    files = _tree(tmp_path, range(12))
    listed = keys.list_objects(spark, str(tmp_path), [1951, 1953, 1951, 2040], "english")
    assert sorted(int(r.key[-9:-4]) for r in listed.collect()) == [1, 3, 5, 7, 9, 11]
    assert {r.length for r in listed.collect()} == {p.stat().st_size for p in files.values() if "1951" in str(p) or "1953" in str(p)}
    assert all("year=1951" in p or "year=1953" in p for p in listed.inputFiles())
    assert keys.list_objects(spark, str(tmp_path), [2040]).count() == 0
    assert keys.list_objects(spark, str(tmp_path), [1951], "hindi").count() == 0


def test_one_row_group_cut_into_many_splits_is_dealt_out(spark, tmp_path):
    """All rows of a row group come with one split; the others of its file are empty."""
    path = str(tmp_path / "table")
    rows = spark.range(2000).select("id", F.sha2(F.col("id").cast("string"), 512).alias("text"))
    rows.repartition(1).write.parquet(path)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        table = spark.read.parquet(path)
        assert table.rdd.getNumPartitions() > 8
        for dealt in (spread(table), read_texts(spark, path, "id"), spread(table.filter("id < 1000"))):
            sizes = [n for n in dealt.rdd.glom().map(len).collect() if n]
            assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)
        assert spread(table).count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_listing_hands_folders_to_the_reader(spark, tmp_path):
    """Objects right below their year are not made roots of their own, one by one."""
    for n in range(40):
        path = tmp_path / f"data/pdf/year={1950 + n % 2}/{n:05d}.pdf"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * (n + 1))
    (tmp_path / "data/pdf/year=1952").mkdir()
    for asked in (None, [1950, 1951, 1952, 2040]):
        listed = keys.list_objects(spark, str(tmp_path), asked)
        assert sorted((r.length, r.year) for r in listed.collect()) == [(n + 1, 1950 + n % 2) for n in range(40)]
        assert "InMemoryFileIndex(2 paths)" in listed._jdf.queryExecution().executedPlan().toString()
    assert keys.list_objects(spark, str(tmp_path), [1952]).count() == 0


def test_many_small_objects_are_few_tasks(spark, tmp_path):
    made = spark.range(6000).select(
        F.concat(F.lit("data/pdf/year="), F.col("id") % 3 + 1950).alias("folder"),
        F.col("id").cast("string").alias("name"), F.col("id").cast("string").alias("value"),
    )
    objects.write_objects(made, str(tmp_path))
    listed = keys.list_objects(spark, str(tmp_path))
    known = spark.createDataFrame(listed.collect(), listed.schema)
    read = objects.readable_objects(spark, str(tmp_path), known)
    every = objects.read_objects(spark, str(tmp_path), "*.txt")
    for found in (listed, read, every):
        assert found.count() == 6000
        assert found.rdd.getNumPartitions() <= 8
    values = read.select(F.btrim(F.col("content").cast("string"), F.lit("\n")).cast("int"))
    assert sorted(r[0] for r in values.collect()) == list(range(6000))


def test_listing_has_no_entry_an_object_on_the_driver(spark, tmp_path):
    """The listing is a table in folders of years; it stays as it was made."""
    made = spark.range(900).select(
        F.concat(F.lit("data/pdf/year="), F.col("id") % 3 + 1950).alias("folder"),
        F.col("id").cast("string").alias("name"), F.col("id").cast("string").alias("value"),
    )
    objects.write_objects(made, str(tmp_path))
    for asked in (None, [1950, 1951, 1952]):
        listed = keys.list_objects(spark, str(tmp_path), asked)
        assert listed.columns == ["key", "year", "length", "modified"]
        assert len(listed.inputFiles()) == 3
    for file in (tmp_path / "data/pdf/year=1951").iterdir():
        file.unlink()
    assert {r.year: r["count"] for r in listed.groupBy("year").count().collect()} == dict.fromkeys((1950, 1951, 1952), 300)
    assert keys.list_objects(spark, str(tmp_path), [1951]).count() == 0


def test_objects_are_read_without_an_index_of_them(spark, tmp_path):
    source = tmp_path / "objects"
    files = _tree(source, range(40))
    listed = keys.list_objects(spark, str(source))
    read = objects.readable_objects(spark, str(source), listed)
    assert not any(path.endswith(".pdf") for path in read.inputFiles())
    contents = {r.key: bytes(r.content) for r in read.collect()}
    assert contents == {str(p.relative_to(source)): p.read_bytes() for p in files.values()}


def test_objects_with_odd_names(spark, tmp_path, monkeypatch):
    """What the tasks list and read themselves is what Spark's reader lists and reads."""
    source = tmp_path / "objects"
    names = [
        "year=1950/a.pdf", "year=1950/english/b c%20+\u00fc.pdf", "year=1950/english/empty.pdf",
        "year=1950/english/.hidden.pdf", "year=1950/english/_hidden.pdf", "year=1950/english/_a=1.pdf",
        "year=1950/.hidden/a.pdf", "year=1950/_hidden/a.pdf", "year=1950/_metadata/a.pdf",
        "year=1950/english/c.pdf._COPYING_", "year=1950/english/_metadata",
        "year=__HIVE_DEFAULT_PARTITION__/a.pdf", "year=1951/deep/er/a.pdf", "year=1952/.hidden",
    ]
    for name in names:
        path = source / "data/pdf" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if "empty" in name else name.encode() + b"\xff")
    (source / "data/pdf/year=1953").mkdir()
    top = source / "data/pdf/year=1950"
    (top / "link").symlink_to(source / "data/pdf/year=1951/deep")
    (top / "nothing.pdf").symlink_to(source / "nothing")
    (tmp_path / "secret.pdf").write_bytes(b"outside")
    odd = [(f"data/pdf/{name}", 1950) for name in (*names, "year=1950/../../../../secret.pdf", "year=1950//a.pdf", "year=1950/\0", "year=1950/english", "year=1950")]
    odd = spark.createDataFrame([*odd, (None, 1950), ("data/pdf/year=1951/deep/er/a.pdf", None)], "key string, year int")

    def found():
        listed = [keys.list_objects(spark, str(source), *asked) for asked in ((), ([1950, 1953],), ([1950], "english"))]
        read = [objects.readable_objects(spark, str(source), rows) for rows in (listed[0], odd)]
        return [sorted(map(str, df.collect())) for df in (*listed, *(r.select("key", "year", "content", "error_msg") for r in read))]

    by_tasks = found()
    for module in (keys, objects):
        monkeypatch.setattr(module, "local_path", lambda *_: None)
    assert found() == by_tasks
    monkeypatch.setattr(objects, "INDEX_FILES", 2)  # a lot for each year
    assert found() == by_tasks
    assert [len(rows) for rows in by_tasks] == [7, 5, 2, 6, 4]


def test_written_objects(spark, tmp_path):
    rows = [("a=1", "x", "one"), ("a=1", "x", "one"), ("a=1", "y", None), ("a=2", "x", "tw\u00f6\nlines")]
    rows = spark.createDataFrame(rows, "folder string, name string, value string").coalesce(1)
    for folder, together in (("apart", False), ("together", True)):
        for _ in range(2):  # a second call leaves the objects of the first alone
            objects.write_objects(rows, str(tmp_path / folder), together)
    def made(folder):
        files = [p for p in (tmp_path / folder).rglob("*") if p.is_file()]
        assert all(p.name.endswith(".txt") and p.name[0] in "xy" for p in files)  # nothing beside them
        return sorted((p.parent.name, p.name[0], p.read_text()) for p in files)
    other = [("a=1", "y", "\n"), ("a=2", "x", "tw\u00f6\nlines\n")] * 2
    assert made("apart") == sorted([("a=1", "x", "one\n")] * 4 + other)
    assert made("together") == sorted([("a=1", "x", "one\none\n")] * 2 + other)


def test_object_tree_makes_no_process_a_file(spark, tmp_path):
    """Hadoop's local files come with a checksum file each and a ``chmod`` for either."""
    judgments = spark.createDataFrame(
        [("a", 1950), ("a", 1950), ("b", 1951), (None, None)], "raw_text string, key_year int"
    )
    queries._object_tree(judgments, str(tmp_path))
    files = [p for p in tmp_path.rglob("*") if p.is_file()]
    made = sorted((p.parent.name, p.read_text()) for p in files)
    assert made == [
        ("year=1950", "a\n"), ("year=1950", "a\n"), ("year=1951", "b\n"),
        ("year=__HIVE_DEFAULT_PARTITION__", "\n"),
    ]


def test_init_store_keeps_rows(spark, tmp_path):
    root = str(tmp_path)
    store.init_store(spark, root)
    assert stored(spark, root).count() == 0
    ingest(documents(spark, range(3)), root, "one")
    store.init_store(spark, root)
    assert stored(spark, root).count() == 3


def test_files(spark, tmp_path):
    names = [
        "data/pdf/year=1996/english/a.pdf", "data/pdf/year=1996/english/b.PDF",
        "data/pdf/year=1996/english/c.txt", "data/pdf/year=1996/hindi/d.pdf",
        "data/pdf/year=1997/english/e.pdf",
    ]
    for name in names:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(name.encode())
    listed = keys.list_objects(spark, str(tmp_path))
    assert sorted(r.key for r in listed.collect()) == names
    pruned = keys.list_objects(spark, str(tmp_path), [1996], "english")
    assert sorted(r.key for r in pruned.collect()) == names[:3]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan or "PartitionFilters: [(year" in plan
    assert "content" not in plan.split("ReadSchema")[1]
    read = objects.read_objects(spark, str(tmp_path / "data"))
    contents = sorted(bytes(r.content).decode() for r in read.collect())
    assert contents == [n for n in names if not n.endswith(".txt")]


def test_mirror(spark, tmp_path):
    """The newest copy by time: names sort otherwise ("9" was made before "10")."""
    root = str(tmp_path / uuid.uuid4().hex)
    for batch, mark in (("9", b"old"), ("10", b"new"), ("10", b"new")):
        source = spark.range(3 if batch == "9" else 1).select(
            F.format_string("k%d", "id").alias("key"), F.lit(mark).alias("content"),
            F.lit(1996).alias("year"),
        )
        objects.mirror_raw(source, root, batch)
    kept = {r.key: bytes(r.content) for r in objects.read_mirror(spark, root).collect()}
    assert kept == {"k0": b"new", "k1": b"old", "k2": b"old"}
