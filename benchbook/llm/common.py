"""What several operators of this folder share: folds, batches of texts, components."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from benchbook.session import fresh_folder

#: Characters of text that a task turns into arrays at once; a longer text is a slice of its own.
SLICE_CHARS = 2_000_000
#: Session setting: rows that Spark hands to Python at once; Spark's default, and that of this folder.
ROWS_SETTING, SPARK_ROWS, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed or sent with ``--py-files``; locally the workers may
    start in any folder. Where the session leaves the rows of an Arrow batch at Spark's default,
    they become fewer: task and worker both hold a batch of whole texts outside the heap.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join(filter(None, [root, *paths]))
    if spark.conf.get(ROWS_SETTING) == SPARK_ROWS:
        spark.conf.set(ROWS_SETTING, BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and go on from there (survives lost executors)."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(doc_id: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit(""))), F.lit(divisor))


def text_of(text: str) -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores after it a name that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most ``limit`` bytes of text, or one row."""
    if batch.num_rows == 0:
        return
    sizes = pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)
    ends = np.cumsum(np.nan_to_num(np.asarray(sizes, dtype=np.float64)))
    start, base = 0, 0.0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start, base = stop, ends[stop - 1]


def lengths(lists: pa.Array) -> np.ndarray:
    """Number of entries of each list; none in a null."""
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def meet(rows: DataFrame, known: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with ``known``, which has one row a key.

    ``weight`` in ``known`` is how many rows have the key. Keys of more than a thousandth of all
    ``total`` rows, which are less than 1,000, meet by a broadcast and never in one task.
    """
    often = F.col(weight) > max(100, total // 1000)
    hot = F.broadcast(known.filter(often))
    rest = rows.join(F.broadcast(known.filter(often).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(known.filter(~often), key))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node with an edge; ``edges`` has ``a, b`` of one ordered type.

    The root is the smallest node of the component. Alternating star contraction: every round
    hangs larger neighbours, then smaller ones, on the smallest neighbour seen, until only stars
    are left (a number of rounds that grows with the logarithm of the longest chain). Minima are
    combined before the shuffle and nodes of very many neighbours meet theirs by a broadcast, so
    they are no hot spot. Every round is written to the shared folder; nothing but two counters comes to the driver.
    """
    pair = edges.filter(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    )
    now, before = stage(pair.distinct(), "edges"), None
    while True:
        state = now.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")
        ).collect()[0]
        if state == before or state["n"] == 0:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        before = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        low = low.select("u", F.least("u", "m").alias("m"), "n")
        # larger neighbours to the smallest one
        large = meet(both, low, "u", "n", 2 * state["n"]).filter(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).distinct()
        # smaller neighbours, and the node itself, to the smallest one
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = meet(large, least, "u", "n", 2 * state["n"]).select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
            F.col("m").alias("v"),
        ).union(least.select("u", F.col("m").alias("v")))
        now = stage(small.filter(F.col("u") != F.col("v")).distinct(), "edges")
