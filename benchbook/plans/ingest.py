"""One load: skip what is done, mirror, score, keep what is new and good, store it, log everything."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from benchbook.functions import fixed_values as V
from benchbook.functions.quality import passes_gate
from benchbook.operators import dedup, log, store
from benchbook.operators.record import EXTRACTOR, with_metadata, with_provenance, with_quality
from benchbook.session import fresh_folder, remove, stage
from benchbook.sources.objects import mirror_raw, object_texts, readable_objects
from benchbook.sources.pages import assemble_pages, keys_to_read_again, with_recognised

SKIPPED = "skipped"
#: Message of a key that was listed, but whose object gave no row.
LOST = "object could not be read"


def ingest(documents: DataFrame, root: str, batch_id: str, **options: object) -> DataFrame:
    """Load ``key, full_text`` (cleaned) into the store; returns ``key, status, error_msg``.

    A row without a text may say why in a column ``error_msg``. See ``load`` for the options.
    """
    wanted = [c for c in ("key", "full_text", "error_msg") if c in documents.columns]
    return load(documents, lambda rows: rows.select(*wanted), root, batch_id, **options)


def ingest_pages(pages: DataFrame, root: str, batch_id: str, **options: object) -> DataFrame:
    """Load ``key, page_no, page_text``: pages of done documents are dropped before they are put
    together, so their texts are neither moved nor cleaned."""
    return load(pages, assemble_pages, root, batch_id, **options)


def ingest_objects(
    listing: DataFrame, objects_root: str, root: str, batch_id: str, **options: object
) -> DataFrame:
    """Load the listed objects (``key, year``, and ``length`` if known) that hold UTF-8 text.

    An object that vanished, cannot be read, is shorter than listed or holds something else
    becomes an ``error`` row that says so; all others are loaded. Objects of skipped keys are not
    read.
    """

    def read(rows: DataFrame) -> DataFrame:
        return object_texts(readable_objects(rows.sparkSession, objects_root, rows))

    return load(listing, read, root, batch_id, listed=listing, **options)


def ingest_recognised(
    recognised: DataFrame, pages: DataFrame, root: str, batch_id: str, **options: object
) -> DataFrame:
    """Load documents anew whose scanned pages have been recognised since they were loaded.

    ``recognised`` has ``key, page_no, page_text`` and, if known, ``recognised_at``; ``pages`` are
    the pages as they were read. What was recognised is kept in the store, so that a page
    recognised now and one recognised by an earlier load both enter the text, each in its newest
    form. Only documents with such pages are put together, whatever their status. A text that
    differs is stored beside the old version, which ``store.current_judgments`` leaves out; one
    that does not is a duplicate.
    """
    spark = pages.sparkSession
    store.init_store(spark, root)
    if store.is_finished(spark, root, batch_id):
        return store.load_outcome(spark, root, batch_id)
    if "recognised_at" not in recognised.columns:
        recognised = recognised.withColumn("recognised_at", F.lit(datetime.now(timezone.utc)))
    new = stage(
        recognised.select("key", "page_no", "page_text", "recognised_at"),
        path=f"{root}/recognised/batch_id={batch_id}",
    )
    again = stage(keys_to_read_again(pages, new), "again")
    known = store.read_table(spark, root, "recognised").join(again, "key", "left_semi")
    merged = with_recognised(pages.join(again, "key", "left_semi"), known)
    return load(merged, assemble_pages, root, batch_id, skip=(), **options)


def load(
    rows: DataFrame,
    prepare: Callable[[DataFrame], DataFrame],
    root: str,
    batch_id: str,
    source: str = "s3",
    endpoint: str = "",
    bucket: str = "",
    skip: tuple[str, ...] = ("done",),
    objects: DataFrame | None = None,
    listed: DataFrame | None = None,
    work: str | None = None,
) -> DataFrame:
    """Load rows with a ``key`` that ``prepare`` turns into ``key, full_text``.

    A finished load is answered with what it returned and changes nothing; a load that broke is
    replaced. Keys whose newest status is in ``skip`` are ``skipped`` (add ``duplicate`` and
    ``low_quality`` to leave settled documents alone). ``objects`` (``key, year, content``) are
    mirrored first, those of skipped keys left out. Keys of ``listed`` that no row came for become
    errors: what was listed but could not be read is logged, and tried again by the next load.

    The texts are read, cleaned, hashed and scored once, and written as they come to ``work``
    (default: the session's shared folder) with a row number. What is decided on is key, hash,
    score and row number: of a key with several texts the smallest hash stands, so exactly the
    text that was judged is stored. The second pass reads the written texts, keeps the chosen
    rows and adds the remaining fields; no aggregate, sort or distinct holds a text.
    """
    spark = rows.sparkSession
    store.init_store(spark, root)
    if store.is_finished(spark, root, batch_id):
        return store.load_outcome(spark, root, batch_id)
    folder = work or fresh_folder(spark, "load")
    keys = rows.select("key")
    if listed is not None:
        listed = listed.select("key").distinct()
        keys = keys.union(listed)
    if store.runs_of(spark, root, "states", batch_id):  # else nothing is settled yet
        keys = stage(keys.distinct(), path=f"{folder}/keys")
    states = log.entries_of(store.read_runs(spark, root, "states", batch_id, keys), keys)
    settled = log.merged_state(states).filter(F.col("status").isin(*skip)).select("key")
    skipped = settled.select("key", F.lit(SKIPPED).alias("status"), F.lit(None).alias("error_msg"))
    if objects is not None:
        mirror_raw(objects.join(settled, "key", "left_anti"), root, batch_id)

    todo = prepare(rows.join(settled, "key", "left_anti"))
    if "error_msg" not in todo.columns:
        todo = todo.withColumn("error_msg", F.lit(None).cast("string"))
    numbered = with_quality(todo).withColumn("row", F.monotonically_increasing_id())
    texts = stage(numbered, path=f"{folder}/texts")
    hashed = F.col("content_hash").isNotNull()
    best = F.min(F.when(hashed, F.struct("content_hash", "row", "quality_score"))).alias("best")
    judged = texts.groupBy("key").agg(best, F.min("error_msg").alias("error_msg"))
    judged = judged.select("key", "best.*", "error_msg")
    if listed is not None:
        lost = listed.join(settled, "key", "left_anti").join(texts.select("key"), "key", "left_anti")
        judged = judged.unionByName(
            lost.withColumn("error_msg", F.lit(LOST)), allowMissingColumns=True
        )
    scored = stage(judged, path=f"{folder}/scored")
    stored = store.read_runs(
        spark, root, "hashes", batch_id, scored.filter(passes_gate(F.col("quality_score")))
    )
    counted = Observation()
    size = F.count_if(F.col("status") == V.DONE).alias("done"), F.count("*").alias("all")
    outcome = stage(
        dedup.ingest_status(scored, stored).union(skipped).observe(counted, *size),
        path=f"{root}/outcome/batch_id={batch_id}",
    )

    done = outcome.filter(F.col("status") == V.DONE).select("key")
    chosen = scored.join(done, "key", "left_semi").select("row", "content_hash")
    new = texts.join(chosen.select("row"), "row", "left_semi").drop("row")
    records = with_metadata(new).withColumn("pdf_s3_key", F.col("key"))
    store.append_judgments(with_provenance(records, endpoint, bucket), root, batch_id)
    store.mark_extracted(spark, root, batch_id, EXTRACTOR)
    entries = outcome.filter(F.col("status") != SKIPPED).select(
        F.lit(source).alias("source"), "key", "status", "error_msg",
        F.lit(datetime.now(timezone.utc)).alias("processed_at"),
    )
    sizes = counted.get
    new_hashes = chosen.select("content_hash").distinct()
    store.append_run(new_hashes, root, "hashes", batch_id, sizes["done"])
    state = log.merged_state(entries.withColumn("batch_id", F.lit(batch_id)))
    store.append_run(state, root, "states", batch_id, sizes["all"])
    store.append_log(entries, root, batch_id)
    for name in ("hashes", "states"):
        store.merge_runs(spark, root, name)
    remove(spark, folder)
    return store.load_outcome(spark, root, batch_id)
