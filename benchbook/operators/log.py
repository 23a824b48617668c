"""The ingest log: appended entries, the latest state of each key, resume and retry.

The log is only ever appended to; the state of a key is an aggregate over its entries, combined
in every task before the shuffle, so a key with very many entries is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.functions import fixed_values as V


def with_order(log: DataFrame) -> DataFrame:
    """Entries with what decides between two of one time: the load, then their own content.

    ``first_at`` is the time of the first entry that a row stands for.
    """
    for name, value in (("batch_id", F.lit("")), ("first_at", F.col("processed_at"))):
        if name not in log.columns:
            log = log.withColumn(name, value.cast("string" if name == "batch_id" else "timestamp"))
    return log


def merged_state(log: DataFrame) -> DataFrame:
    """One row per key of entries or of earlier results of this function, with its times.

    The newest entry as a whole and the source of the oldest: each is one extreme of whole rows
    in a total order, so equal times give one answer however the rows are spread.
    """
    newest = F.max(F.struct("processed_at", "batch_id", "status", "error_msg")).alias("_new")
    oldest = F.min(F.struct("first_at", F.col("source").isNull(), "source")).alias("_old")
    return with_order(log).groupBy("key").agg(newest, oldest).select(
        "key",
        F.col("_old")["source"].alias("source"),
        F.col("_new")["status"].alias("status"),
        F.col("_new")["error_msg"].alias("error_msg"),
        F.col("_new")["processed_at"].alias("processed_at"),
        F.col("_old")["first_at"].alias("first_at"),
        F.col("_new")["batch_id"].alias("batch_id"),
    )


def latest_state(log: DataFrame) -> DataFrame:
    """One row per key: first source, newest status, its message (even if NULL) and time."""
    return merged_state(log).drop("first_at", "batch_id")


def done_keys(log: DataFrame, done: str = V.DONE) -> DataFrame:
    return latest_state(log).filter(F.col("status") == done).select("key")


def retry_candidates(log: DataFrame, done: str = V.DONE) -> DataFrame:
    """Keys whose newest status is not the finished one."""
    return latest_state(log).filter(F.col("status") != done)


def entries_of(log: DataFrame, keys: DataFrame) -> DataFrame:
    """Entries of some keys: what a small load asks of a long log needs no shuffle of it."""
    return log.join(keys.select("key"), "key", "left_semi")


def not_done(keys: DataFrame, log: DataFrame, done: str = V.DONE) -> DataFrame:
    """Listed keys still to process. All join types are left to the measured sizes."""
    return keys.join(done_keys(entries_of(log, keys), done), "key", "left_anti")


def run_summary(outcomes: DataFrame) -> DataFrame:
    """One row of counters over ``status``, as a load returns it (``skipped``: already done).

    ``stored`` counts everything processed without an error and ``skipped`` includes logged
    errors; errors have a counter of their own as well.
    """
    status = F.col("status")
    return outcomes.agg(
        F.count_if(status.isin(V.DONE, V.DUPLICATE, V.LOW_QUALITY)).alias("stored"),
        F.count_if(status.isin("skipped", V.ERROR)).alias("skipped"),
        F.count_if(status == V.ERROR).alias("logged_errors"),
        F.count("*").alias("processed"),
    )


def status_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status").agg(F.count("*").alias("n"))
