"""Fresh results against stored rows, and lookups of stored rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchbook.operators.store import stored_value

#: Parts that keys are dealt to by their hash when two tables are compared by digests.
PARTS = 4096

STORED_FIELDS = (
    "title", "case_number", "year", "judgment_date", "bench", "result", "quality_score",
)


def lookup_by_suffix(stored: DataFrame, suffix: str) -> DataFrame:
    """One row whose key ends in a LIKE pattern (``_`` is any character); smallest key."""
    return stored.filter(F.col("pdf_s3_key").like(f"%{suffix}")).orderBy("pdf_s3_key").limit(1)


def lookup_by_key(stored: DataFrame, key: str, fields: tuple[str, ...] = STORED_FIELDS) -> DataFrame:
    return stored.filter(F.col("pdf_s3_key") == key).select("pdf_s3_key", *fields)


def _stored_of(keys: DataFrame, stored: DataFrame) -> DataFrame:
    """One stored row for each of the keys that has any.

    A key may be stored again after its object changed; the newest load speaks for it (within
    one time the largest load name, then the smallest hash).
    """
    asked = stored.withColumn("key", F.col("pdf_s3_key")).join(
        keys.select("key"), "key", "left_semi"
    )
    rows = _newest_stored(asked)
    return rows.select("key", F.struct(*STORED_FIELDS).alias("stored"))


def _newest_stored(stored: DataFrame) -> DataFrame:
    """``key`` and the compared fields of the newest stored row of each key."""
    asked = stored.withColumn("key", F.col("pdf_s3_key"))
    age = [c for c in ("loaded_at", "batch_id") if c in stored.columns]
    newest = asked.groupBy("key", "content_hash").agg(
        F.max_by(F.struct(*STORED_FIELDS), F.struct(F.lit(0), *age)).alias("row"),
        F.max(F.struct(F.lit(0), *age)).alias("age"),
    )
    # the largest age, and of equal ones the smallest hash
    last = newest.groupBy("key").agg(F.max("age").alias("last"))
    same = newest.join(last, "key").filter(F.col("age") == F.col("last"))
    one = same.groupBy("key").agg(F.min_by("row", "content_hash").alias("stored"))
    return one.select("key", "stored.*")


def cross_check(keys: DataFrame, stored: DataFrame) -> DataFrame:
    """Every processed key, whether it is stored, and what is stored for it."""
    found = keys.select("key").join(_stored_of(keys, stored), "key", "left")
    return found.select(
        "key",
        F.when(F.col("stored").isNull(), "NOT IN DB").otherwise("IN DB").alias("state"),
        *[F.col("stored")[f].alias(f) for f in STORED_FIELDS],
    )


def _digests(rows: DataFrame, part: Column) -> DataFrame:
    """Number and sum of row hashes by part of the keys: equal for equal rows in any order.

    Sums are combined in every task before the shuffle, so it moves ``PARTS`` rows a task at most.
    """
    digest = F.xxhash64("key", *STORED_FIELDS).cast("decimal(38,0)")
    return rows.groupBy(part.alias("part")).agg(
        F.count("*").alias("n"), F.sum(digest).alias("digest")
    )


def changed_rows(records: DataFrame, stored: DataFrame) -> DataFrame:
    """``key, differing`` of the keys whose stored fields are not what is fresh, and no others.

    Both sides are first reduced to a digest for each part of their keys; only parts whose digests
    differ are compared row by row, so an unchanged store costs two aggregates. At most ``PARTS``
    numbers come to the driver. A key on one side only makes its part differ, but is not returned.
    """
    part = F.pmod(F.xxhash64("key"), F.lit(PARTS)).cast("int")
    fresh = records.select(
        F.col("pdf_s3_key").alias("key"),
        *[stored_value(records.schema[f]).alias(f) for f in STORED_FIELDS],
    )
    kept = _newest_stored(stored)
    both = _digests(fresh, part).alias("a").join(_digests(kept, part).alias("b"), "part", "full_outer")
    same = F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.digest").eqNullSafe(F.col("b.digest"))
    differing = [r["part"] for r in both.filter(~same).select("part").collect()]
    if not differing:
        return records.sparkSession.createDataFrame([], "key string, differing array<string>")
    mine = F.pmod(F.xxhash64("pdf_s3_key"), F.lit(PARTS)).cast("int").isin(differing)
    found = cross_check_diff(records.filter(mine), stored.filter(mine))
    return found.filter(F.size("differing") > 0)


def cross_check_diff(records: DataFrame, stored: DataFrame) -> DataFrame:
    """Keys on both sides with the names of the fields whose stored form differs."""
    fresh = records.select(
        F.col("pdf_s3_key").alias("key"),
        F.struct(*[stored_value(records.schema[f]).alias(f) for f in STORED_FIELDS]).alias("fresh"),
    )
    both = fresh.join(_stored_of(fresh, stored), "key")
    differing = [
        F.when(~F.col("fresh")[f].eqNullSafe(F.col("stored")[f]), F.lit(f)) for f in STORED_FIELDS
    ]
    return both.select("key", F.array_compact(F.array(*differing)).alias("differing"))
