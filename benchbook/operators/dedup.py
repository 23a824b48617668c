"""Insert-if-absent on the content hash, and the status it gives each document.

Every step moves keys and hashes only. Copies of one text are reduced to their smallest key by
a partial aggregate before the shuffle, so a hash that a third of all documents share costs one
row per task; afterwards both sides of the join with the store hold each hash once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchbook.functions import fixed_values as V
from benchbook.functions.quality import passes_gate


#: Message of an error row whose document came without one.
NO_TEXT = "document has no readable text"


def first_of_each_hash(hashed: DataFrame) -> DataFrame:
    """``content_hash`` and the smallest ``key`` that has it."""
    return hashed.groupBy("content_hash").agg(F.min("key").alias("key"))


def absent(hashed: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows whose hash the store does not hold.

    The store is first cut down to the hashes asked for, each once on both sides: a text copied
    into a third of all rows is one row in the join. A small load can be broadcast for that, and
    then the hashes of a store of any size are only read, not shuffled.
    """
    asked = hashed.select("content_hash").distinct()
    known = stored.select("content_hash").join(asked, "content_hash", "left_semi").distinct()
    return hashed.join(known, "content_hash", "left_anti")


def new_keys(hashed: DataFrame, stored: DataFrame) -> DataFrame:
    """Keys to insert: the first of each hash that the store does not hold."""
    return absent(first_of_each_hash(hashed), stored).select("key")


def insert_if_absent(records: DataFrame, stored: DataFrame, key: str = "key") -> DataFrame:
    """Records to append, one per new hash; their number is the inserted count."""
    chosen = new_keys(records.select(F.col(key).alias("key"), "content_hash"), stored)
    return records.join(chosen.withColumnRenamed("key", key), key, "left_semi")


def _status(is_new: Column) -> Column:
    return (
        F.when(F.col("content_hash").isNull(), V.ERROR)
        .when(~passes_gate(F.col("quality_score")), V.LOW_QUALITY)
        .when(is_new, V.DONE)
        .otherwise(V.DUPLICATE)
    )


def ingest_status(scored: DataFrame, stored: DataFrame) -> DataFrame:
    """``key, status, error_msg`` for each ``key, content_hash, quality_score``.

    Keys must be distinct. A document without a text has a NULL hash and becomes an error, with
    the ``error_msg`` it came with, if any. ``scored`` is read twice, so pass a staged table when
    it is costly to compute.
    """
    good = scored.filter(passes_gate(F.col("quality_score")))
    new = new_keys(good, stored).withColumn("is_new", F.lit(True))
    problem = F.lit(NO_TEXT)
    if "error_msg" in scored.columns:
        problem = F.coalesce("error_msg", problem)
    return scored.join(new, "key", "left").select(
        "key",
        _status(F.col("is_new")).alias("status"),
        F.when(F.col("content_hash").isNull(), problem).alias("error_msg"),
    )


def quality_gate(scored: DataFrame) -> DataFrame:
    return scored.filter(passes_gate(F.col("quality_score")))


def low_quality(scored: DataFrame) -> DataFrame:
    return scored.filter(~passes_gate(F.col("quality_score")))
