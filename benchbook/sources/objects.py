"""Raw objects: reading them whole, and mirroring them before any judgement of quality."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchbook import schema
from benchbook.functions import fixed_values as V
from benchbook.functions.normalize import clean_text
from benchbook.session import exists, fresh_folder, local_path
from benchbook.sources.keys import key_of
from benchbook.sources.mounted import with_content
from benchbook.sources.texts import gathered

#: Listed objects, and bytes of them, that one task reads.
TASK_FILES, TASK_BYTES = 4096, 128 << 20
#: Listed objects whose folders one file index on the driver holds.
INDEX_FILES = 100_000


def read_objects(spark: SparkSession, path: str, glob: str = "*.[pP][dD][fF]") -> DataFrame:
    """Objects below ``path`` as ``path, length, content``; corrupt files raise.

    ``readable_objects`` goes on past them.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return gathered(files, files.select("path", "length", "content"))


def write_objects(rows: DataFrame, folder: str, together: bool = False) -> None:
    """``folder, name, value`` as files of text below a mounted ``folder``, each ended by a line end.

    The tasks that have the rows write them, named ``name``, a mark of this call, the number of the
    task and a count; with ``together`` rows of one name in a task are lines of one object. A
    task that runs again writes the same names, and a file appears only when it is whole.

    For folders on the file system of the machines only. Spark's writers go through Hadoop's
    class for those, which without its native library starts a process for every file it makes
    (``chmod``); hundreds of thousands of small objects then cost minutes that no object asks for.
    """
    mark = uuid.uuid4().hex[:12]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        task = TaskContext.get()
        part, attempt = task.partitionId(), task.taskAttemptId()
        last, number, lines, made = None, 0, [], set()

        def put() -> None:
            place = f"{folder}/{last[0]}"
            if place not in made:
                os.makedirs(place, exist_ok=True)
                made.add(place)
            name = f"{last[1]}-{mark}-{part:05d}-{number}.txt"
            with open(f"{place}/.{name}.{attempt}", "wb") as file:
                file.write(b"".join(lines))
            os.replace(f"{place}/.{name}.{attempt}", f"{place}/{name}")

        written = 0
        for batch in batches:
            for *to, value in zip(*(c.to_pylist() for c in batch.columns)):
                if lines and not (together and to == last):
                    put()
                    written += 1
                    lines = []
                number = number + 1 if to == last and not lines else 0
                last = to
                lines += [value or b"", b"\n"]
        if lines:
            put()
            written += 1
        yield pa.RecordBatch.from_pydict({"n": [written]})

    columns = rows.select("folder", "name", F.col("value").cast("binary").alias("value"))
    files = columns.sortWithinPartitions("folder", "name").mapInArrow(run, "n long")
    files.write.format("noop").mode("overwrite").save()


def readable_objects(
    spark: SparkSession, root: str, listing: DataFrame, prefix: str = V.KEY_ROOT
) -> DataFrame:
    """``key, year, content, error_msg`` of the listed objects below ``root`` that are there.

    Nothing raises: an object that vanished or cannot be read gives no row, and the load that was
    handed the listing logs it as lost. One of another length than the listing's (where that has
    a ``length``) gives a row without content that says so. Year folders that nobody listed
    are not looked at. One row a listed year comes to the driver.

    On a file system that is mounted the tasks that have the rows of the listing read their
    objects. Elsewhere Spark's reader does, whose entries the driver holds: of a year, or of years
    of some ``INDEX_FILES`` listed objects together; if these are several lots, what was read is
    kept in the shared folder.
    """
    expected = ["length"] if "length" in listing.columns else []
    size = F.sum("length") if expected else F.lit(None)
    counted = listing.groupBy("year").agg(F.count("*").alias("n"), size.alias("size")).collect()
    years = {r["year"]: r for r in sorted((r for r in counted if r["year"]), key=lambda r: r["year"])}
    wanted = listing.select("key", "year", *expected).distinct()
    if mounted := local_path(spark, root):
        n, size = (sum(r[c] or 0 for r in years.values()) for c in ("n", "size"))
        most = max(spark.sparkContext.defaultParallelism, n // TASK_FILES, size // TASK_BYTES)
        start = f"{prefix}year="
        year = F.split_part(F.substr("key", F.lit(len(start) + 1)), F.lit("/"), F.lit(1))
        listed = F.startswith("key", F.lit(start)) & year.isin([str(y) for y in years])
        both = with_content(
            wanted.filter(listed).repartition(max(1, min(n, most)), "key"), mounted, prefix
        )
    else:
        both = _by_index(spark, root, wanted, {y: r["n"] for y, r in years.items()}, prefix)
    both = both.select("key", "content", "year", *expected)
    if not expected:
        return both.withColumn("error_msg", F.lit(None).cast("string"))
    size = F.octet_length("content")
    short = F.when(
        size != F.col("length"), F.format_string("object has %d of %d bytes", size, F.col("length"))
    )
    marked = both.withColumn("error_msg", short)
    return marked.withColumn("content", F.when(F.col("error_msg").isNull(), F.col("content"))).drop("length")


def _by_index(
    spark: SparkSession, root: str, wanted: DataFrame, years: dict[int, int], prefix: str
) -> DataFrame:
    """Listed rows with the ``content`` that Spark's reader finds for them, by lots of years."""
    lots, left = [], 0
    for year, n in years.items():
        folder = f"{root}/{prefix}year={year}"
        if exists(spark, folder):
            if n > left:
                lots.append([])
                left = INDEX_FILES
            lots[-1].append(folder)
            left -= n
    place = fresh_folder(spark, "objects")
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    reader = reader.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    both = wanted.withColumn("content", F.lit(None).cast("binary")).limit(0)
    for folders in lots:
        files = reader.load(folders)
        found = gathered(files, files.select("path", "content"))
        both = found.select(key_of("path", prefix).alias("key"), "content").join(wanted, "key")
        if len(lots) > 1:
            both.write.mode("append").parquet(place)
    return both if len(lots) < 2 else spark.read.schema(both.schema).parquet(place)


def object_texts(objects: DataFrame) -> DataFrame:
    """``key, full_text, error_msg`` of objects that hold UTF-8 text: cleaned, or why there is none."""
    valid = F.is_valid_utf8(F.col("content").cast("string"))
    text = clean_text(F.when(valid, F.col("content").cast("string")))
    broken = F.when(F.col("content").isNotNull() & ~valid, F.lit("object is not UTF-8 text"))
    return objects.select(
        "key", text.alias("full_text"), F.coalesce("error_msg", broken).alias("error_msg")
    )


def mirror_raw(objects: DataFrame, root: str, batch_id: str) -> str:
    """Copy ``key, year, content`` under ``root``; returns the path of this load's copy.

    Rows are written by the tasks that read them, without a shuffle, and carry the time of the
    copy. A load owns its folder, so running it again replaces its own copy and nothing else.
    """
    path = f"{root}/mirror/batch_id={batch_id}"
    copies = objects.select("key", "content", F.current_timestamp().alias("loaded_at"), "year")
    copies.write.mode("overwrite").partitionBy("year").parquet(path)
    return path


def read_mirror(spark: SparkSession, root: str) -> DataFrame:
    """Latest copy of each key, by the time it was made, then by the name of the load.

    Only keys, times and names are compared, never contents.
    """
    copies = spark.read.schema(schema.MIRROR).parquet(f"{root}/mirror")
    newest = F.max(F.struct("loaded_at", "batch_id")).alias("newest")
    latest = copies.groupBy("key").agg(newest).select("key", "newest.*")
    return copies.join(latest, ["key", "loaded_at", "batch_id"], "left_semi")
