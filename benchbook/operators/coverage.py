"""How well each field is filled: per document, per field, per year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchbook.functions import fixed_values as V
from benchbook.schema import JUDGMENTS
from benchbook.session import exists, folders_in
from benchbook.sources.keys import key_year


def is_empty(df: DataFrame, field: str) -> Column:
    """NULL, a string or list of length 0, or the number 0."""
    c, kind = F.col(field), df.schema[field].dataType
    if isinstance(kind, T.ArrayType):
        blank = F.size(c) == 0
    elif isinstance(kind, T.StringType):
        blank = c == ""
    else:
        blank = c == 0
    return c.isNull() | blank


def fields_populated(records: DataFrame, key: str = "pdf_s3_key") -> DataFrame:
    """Per document: how many report fields hold a value, and the names of those that do not."""
    missing = F.array_compact(
        F.array(*[F.when(is_empty(records, f), F.lit(f)) for f in V.REPORT_FIELDS])
    )
    return records.select(F.col(key).alias("key"), missing.alias("missing")).select(
        "key", (F.lit(len(V.REPORT_FIELDS)) - F.size("missing")).alias("populated"), "missing"
    )


def _empty_counts(records: DataFrame, *group: Column) -> DataFrame:
    # one wide row per group, combined in every task; turned into rows per field afterwards
    counts = [F.count_if(is_empty(records, f)).alias(f) for f in V.REPORT_FIELDS]
    wide = records.groupBy(*group).agg(F.count("*").alias("total"), *counts)
    ids = [c for c in wide.columns if c not in V.REPORT_FIELDS]
    return wide.unpivot(ids, list(V.REPORT_FIELDS), "field", "empty")


def _with_percent(counts: DataFrame) -> DataFrame:
    share = F.when(F.col("total") > 0, F.col("empty") / F.col("total") * 100).otherwise(0.0)
    return counts.withColumn("percent", share).withColumn(
        "weak", F.col("percent") >= V.WEAK_FIELD_PERCENT
    )


def field_coverage(records: DataFrame) -> DataFrame:
    """Per field: empty count, total, percent, and a flag for weak fields; 16 rows always."""
    return _with_percent(_empty_counts(records))


def field_coverage_by_year(records: DataFrame, key_year: Column) -> DataFrame:
    """The same per year of the key."""
    return _with_percent(_empty_counts(records, key_year.alias("key_year")))


def count_loads(spark: SparkSession, root: str) -> None:
    """Count the empty fields of every finished load that has not been counted yet, by year.

    A load's counts are a few rows in a folder of its own; a load's rows never change, so it is
    counted once. Only the report fields are read, no text.
    """
    for folder in folders_in(spark, f"{root}/ingest_log"):
        done = exists(spark, f"{root}/ingest_log/{folder}/_SUCCESS")
        if not done or exists(spark, f"{root}/coverage/{folder}/_SUCCESS"):
            continue
        rows = spark.read.schema(JUDGMENTS).parquet(f"{root}/judgments/{folder}")
        counts = _empty_counts(rows, key_year(F.col("pdf_s3_key")).alias("key_year"))
        counts.coalesce(1).write.mode("overwrite").parquet(f"{root}/coverage/{folder}")


def coverage_of_loads(spark: SparkSession, root: str) -> DataFrame:
    """Coverage of all stored rows and, in the same pass, of each year (``key_year`` NULL: all).

    The counts of the loads are added up, so the report reads neither judgments nor texts.
    ``every_year`` marks the rows over all years, as a key without a year has none either.
    """
    count_loads(spark, root)
    kind = "key_year int, total long, field string, empty long"
    counts = spark.read.schema(kind).parquet(f"{root}/coverage/batch_id=*")
    sums = [F.sum("empty").alias("empty"), F.sum("total").alias("total")]
    found = counts.groupingSets([["field"], ["field", "key_year"]], "field", "key_year").agg(
        *sums, (F.grouping("key_year") == 1).alias("every_year")
    )
    return _with_percent(found)
