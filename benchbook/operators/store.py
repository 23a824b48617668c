"""The store: parquet tables under one root, written one load at a time.

Each load owns a folder of each table. The folder of its log is written last and marks it as
finished: a finished load is never written again, an unfinished one is replaced as a whole. Two
loads must not run against one store at the same time: nothing here locks.

Loads read neither the stored judgments nor the log, but two compact copies: the hashes that are
stored and the newest state of each key. Every load adds a run to them, and runs are merged like
digits are carried: ``FAN`` runs of a level become one run of the next. So a load reads a number
of runs that grows with the logarithm of the number of loads.

A run lies in folders by the first bits of its hash (of its key's hash, for states), as many
folders as keep each at about ``FOLDER_ROWS`` rows. A load reads the folders of its own hashes and
keys only: what it reads is bounded by what it asks, not by what is stored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.readwriter import DataFrameWriter

from benchbook import schema
from benchbook.operators import log
from benchbook.operators.record import EXTRACTOR, reparse
from benchbook.session import exists, folders_in, make_folder, remove

_TABLES = {
    "judgments": (schema.JUDGMENTS, ["batch_id"]),
    "ingest_log": (schema.INGEST_LOG, ["batch_id"]),
    "outcome": (schema.OUTCOME, ["batch_id"]),
    "mirror": (schema.MIRROR, ["batch_id", "year"]),
    "recognised": (schema.RECOGNISED, ["batch_id"]),
}
#: Runs of one level that are merged into one of the next.
FAN = 8
#: Rows that a folder of a run is meant to hold, and bits of a prefix at most (65,536 folders).
FOLDER_ROWS, PREFIX_BITS = 8192, 16


def init_store(spark: SparkSession, root: str) -> None:
    """Create the tables that do not exist yet; safe to repeat."""
    for name, (columns, partitions) in _TABLES.items():
        if exists(spark, f"{root}/{name}"):
            continue
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in columns]
        empty = spark.range(0).select(*nothing)
        empty.write.mode("ignore").partitionBy(*partitions).parquet(f"{root}/{name}")


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name][0]).parquet(f"{root}/{name}")


def is_finished(spark: SparkSession, root: str, batch_id: str) -> bool:
    return exists(spark, f"{root}/ingest_log/batch_id={batch_id}/_SUCCESS")


def load_outcome(spark: SparkSession, root: str, batch_id: str) -> DataFrame:
    """What a finished load returned."""
    found = read_table(spark, root, "outcome").filter(F.col("batch_id") == batch_id)
    return found.drop("batch_id")


def stored_value(field: T.StructField) -> Column:
    """Stored form of a field: NULL text is empty, NULL list is empty, other NULLs stay."""
    value = F.col(field.name)
    if field.dataType == T.StringType():
        return F.coalesce(value, F.lit(""))
    if isinstance(field.dataType, T.ArrayType):
        return F.coalesce(value, F.array().cast(field.dataType))
    return value


def storable(records: DataFrame) -> DataFrame:
    fields = [f for f in schema.JUDGMENTS if f.name not in ("batch_id", "loaded_at")]
    columns = [stored_value(f).alias(f.name) for f in fields]
    loaded = F.col("loaded_at") if "loaded_at" in records.columns else F.current_timestamp()
    return records.select(*columns, loaded.alias("loaded_at"))


def append_judgments(records: DataFrame, root: str, batch_id: str) -> None:
    """Write one load from the tasks that made the records: texts are not moved.

    ``compact`` puts them in order of their keys, off the path of the loads. Until then a Bloom
    filter of the keys in each row group tells a lookup which ones it need not read.
    """
    _writer(storable(records)).parquet(f"{root}/judgments/batch_id={batch_id}")


def _writer(judgments: DataFrame) -> DataFrameWriter:
    """Row groups with a Bloom filter of their keys, sized by the keys they hold, up to 1 MB."""
    name = "parquet.bloom.filter"
    return (
        judgments.write.mode("overwrite").option(f"{name}.enabled#pdf_s3_key", "true")
        .option(f"{name}.adaptive.enabled", "true").option(f"{name}.max.bytes", str(1 << 20))
    )


def compact(spark: SparkSession, root: str, batch_id: str) -> None:
    """Lay the judgments of a finished load out anew, in order of their keys (and so by year).

    The one step that moves stored texts, by ranges of keys, so no year is one task. A filter on
    a key or a range of keys then reads the row groups that may hold it.
    """
    def placed(rows: DataFrame) -> DataFrame:
        return rows.repartitionByRange("pdf_s3_key").sortWithinPartitions("pdf_s3_key")

    _rewrite(spark, root, batch_id, "compacting", placed)


def _rewrite(
    spark: SparkSession,
    root: str,
    batch_id: str,
    name: str,
    change: Callable[[DataFrame], DataFrame],
) -> None:
    """Replace the judgments of a load by a changed form, written whole before it takes its place.

    If that breaks, the next attempt goes on from the last finished step.
    """
    path, fresh = (f"{root}/{folder}/batch_id={batch_id}" for folder in ("judgments", name))
    rows = T.StructType([f for f in schema.JUDGMENTS if f.name != "batch_id"])
    if not exists(spark, f"{fresh}/_SUCCESS"):
        change(spark.read.schema(rows).parquet(path)).write.mode("overwrite").parquet(fresh)
    _writer(spark.read.schema(rows).parquet(fresh)).parquet(path)
    remove(spark, fresh)


def mark_extracted(spark: SparkSession, root: str, batch_id: str, version: int) -> None:
    """Note by which version of the rules the fields of a load were derived: an empty folder."""
    make_folder(spark, f"{root}/extractor/batch_id={batch_id}/version={version}")


def reextract(spark: SparkSession, root: str, version: int = EXTRACTOR) -> list[str]:
    """Derive the fields of all finished loads of an older version anew; returns their names.

    Each load is rewritten from its own texts, in the tasks that read them, and marked; a run that
    broke goes on where it was, and one with nothing to do reads folder names only. Loads without
    a mark count as oldest.
    """
    done = []
    for folder in folders_in(spark, f"{root}/ingest_log"):
        batch_id = folder.removeprefix("batch_id=")
        marks = folders_in(spark, f"{root}/extractor/{folder}")
        known = max((int(m.removeprefix("version=")) for m in marks), default=0)
        if known < version and is_finished(spark, root, batch_id):
            _rewrite(
                spark, root, batch_id, "reextracting",
                lambda rows: storable(reparse(rows, ("source_url", "loaded_at"))),
            )
            mark_extracted(spark, root, batch_id, version)
            done.append(batch_id)
    return done


def append_log(entries: DataFrame, root: str, batch_id: str) -> None:
    """Write the log of one load; the load is finished with it."""
    columns = [f.name for f in schema.INGEST_LOG if f.name != "batch_id"]
    entries.select(*columns).write.mode("overwrite").parquet(
        f"{root}/ingest_log/batch_id={batch_id}"
    )


def current_judgments(stored: DataFrame) -> DataFrame:
    """Stored rows without those that a later load superseded: the newest version of each key.

    Newest by time, then by load, then the smallest hash. Only keys, times and names are compared,
    in every task before the shuffle; texts are read where they lie.
    """
    version = ("loaded_at", "batch_id", "content_hash")
    newest = F.max(F.struct("loaded_at", "batch_id")).alias("newest")
    last = stored.groupBy("pdf_s3_key").agg(newest).select("pdf_s3_key", "newest.*")
    same = stored.select("pdf_s3_key", *version).join(last, ["pdf_s3_key", *version[:2]], "left_semi")
    one = same.groupBy("pdf_s3_key", *version[:2]).agg(F.min("content_hash").alias("content_hash"))
    return stored.join(one, ["pdf_s3_key", *version], "left_semi")


# ---- compact copies ----------------------------------------------------------------------


@dataclass(frozen=True)
class Copy:
    """How a compact copy is laid out: what it asks by, its prefix, its stored form, its merge."""

    columns: T.StructType
    asked_by: str
    prefix: Callable[[], Column]
    packed: Callable[[], list[Column]]
    unpacked: Callable[[], list[Column]]
    merge: Callable[[DataFrame], DataFrame]


COPIES = {
    "hashes": Copy(
        schema.HASHES,
        "content_hash",
        lambda: F.conv(F.left("content_hash", F.lit(PREFIX_BITS // 4)), 16, 10).cast("int"),
        lambda: [F.unhex("content_hash").alias("digest")],
        lambda: [F.lower(F.hex("digest")).alias("content_hash")],
        DataFrame.distinct,
    ),
    "states": Copy(
        schema.STATES,
        "key",
        lambda: F.shiftrightunsigned(F.xxhash64("key"), 64 - PREFIX_BITS).cast("int"),
        lambda: [F.col(c) for c in schema.STATES.names],
        lambda: [F.col(c) for c in schema.STATES.names],
        log.merged_state,
    ),
}


def _complete(spark: SparkSession, place: str) -> list[tuple[str, int]]:
    """Folder and prefix bits of a run that was written to its end; else nothing."""
    found = [(f"{place}/{d}", int(d[5:])) for d in folders_in(spark, place) if d.startswith("bits=")]
    return [x for x in found if exists(spark, f"{x[0]}/_SUCCESS")]


def runs_of(spark: SparkSession, root: str, name: str, batch_id: str = "") -> list[tuple[str, int]]:
    """Folders and prefix bits of all runs but an earlier, unfinished attempt of this load."""
    out = []
    for level in folders_in(spark, f"{root}/{name}"):
        for run in folders_in(spark, f"{root}/{name}/{level}"):
            if run != f"run={batch_id}":
                out += _complete(spark, f"{root}/{name}/{level}/{run}")
    return out


def _read(spark: SparkSession, name: str, paths: list[str]) -> DataFrame:
    copy = COPIES[name]
    if not paths:
        nothing = spark.createDataFrame([], copy.columns).filter(F.lit(False))  # seen as empty
        return nothing.select(*copy.unpacked())
    reader = spark.read.schema(copy.columns).option("recursiveFileLookup", "true")
    return reader.parquet(*paths).select(*copy.unpacked())


def read_runs(
    spark: SparkSession, root: str, name: str, batch_id: str = "", asked: DataFrame | None = None
) -> DataFrame:
    """``hashes`` (``content_hash``) or ``states`` of all loads but an unfinished one of this name.

    With ``asked``, which has the column they are asked by, only folders that may hold one of its
    values are read; rows of other values are among them. Only prefixes come to the driver, at
    most ``2**PREFIX_BITS`` small numbers. ``asked`` is not looked at while all runs are one folder.
    """
    runs = runs_of(spark, root, name, batch_id)
    if asked is None or not any(bits for _, bits in runs):
        return _read(spark, name, [path for path, _ in runs])
    copy = COPIES[name]
    values = asked.filter(F.col(copy.asked_by).isNotNull()).select(copy.prefix().alias("prefix"))
    prefixes = {r["prefix"] for r in values.distinct().collect()}
    paths = []
    for path, bits in runs:
        wanted = {f"prefix={p >> (PREFIX_BITS - bits)}" for p in prefixes}
        there = folders_in(spark, path)
        hit = [d for d in there if d in wanted]
        paths += [path] if hit and len(hit) == len(there) else [f"{path}/{d}" for d in hit]
    return _read(spark, name, paths)


def write_run(rows: DataFrame, root: str, name: str, level: int, run: str, size: int) -> None:
    """Write a run of about ``size`` rows, each folder sorted and by one task."""
    spark, copy = rows.sparkSession, COPIES[name]
    bits = min(max(0, (size - 1) // FOLDER_ROWS).bit_length(), PREFIX_BITS)
    place = f"{root}/{name}/level={level}/run={run}"
    remove(spark, place)  # an attempt that broke may have had other folders
    prefix = F.shiftright(copy.prefix(), PREFIX_BITS - bits)
    marked = rows.withColumn("prefix", F.coalesce(prefix, F.lit(0)))
    if bits:
        marked = marked.repartition("prefix")
    placed = marked.sortWithinPartitions("prefix", copy.asked_by)
    stored = placed.select("prefix", *copy.packed())
    stored.write.partitionBy("prefix").parquet(f"{place}/bits={bits}")


def append_run(rows: DataFrame, root: str, name: str, batch_id: str, size: int) -> None:
    write_run(rows, root, name, 0, batch_id, size)


def merge_runs(spark: SparkSession, root: str, name: str) -> None:
    """Carry full levels on. A merged run is complete before its parts are deleted; if that is
    interrupted, rows are there twice, which neither sets nor newest states mind."""
    level = 0
    while True:
        place = f"{root}/{name}/level={level}"
        runs = [r for r in folders_in(spark, place) if level or is_finished(spark, root, r[4:])]
        if len(runs) < FAN:
            return
        parts = [path for r in runs for path, _ in _complete(spark, f"{place}/{r}")]
        rows = _read(spark, name, parts)
        # named after its last part: a load's name is unique, so is this one in its level
        write_run(COPIES[name].merge(rows), root, name, level + 1, runs[-1][4:], rows.count())
        for r in runs:
            remove(spark, f"{place}/{r}")
        level += 1
