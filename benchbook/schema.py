"""Schemas of the tables: extracted record, stored judgments, ingest log, pages, keys."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXTS = T.ArrayType(T.StringType())

# The 19 fields of an extracted record, in order.
RECORD = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("full_text", T.StringType()),
        T.StructField("case_number", T.StringType()),
        T.StructField("case_type", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("judgment_date", T.StringType()),
        T.StructField("bench", _TEXTS),
        T.StructField("petitioner", T.StringType()),
        T.StructField("respondent", T.StringType()),
        T.StructField("result", T.StringType()),
        T.StructField("acts_cited", _TEXTS),
        T.StructField("cases_cited", _TEXTS),
        T.StructField("tags", _TEXTS),
        T.StructField("summary", T.StringType()),
        T.StructField("holding", T.StringType()),
        T.StructField("applicability", T.StringType()),
        T.StructField("content_hash", T.StringType()),
        T.StructField("quality_score", T.DoubleType()),
        T.StructField("pdf_s3_key", T.StringType()),
    ]
)
TEXT_FIELDS = [f.name for f in RECORD if f.dataType == T.StringType()]
LIST_FIELDS = [f.name for f in RECORD if f.dataType == _TEXTS]

# The stored table: the record, where it came from, and the load that added it.
JUDGMENTS = T.StructType(
    [f for f in RECORD if f.name != "year"]
    + [
        T.StructField("source_url", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
    ]
)

INGEST_LOG = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

PAGES = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("page_no", T.IntegerType()),
        T.StructField("page_text", T.StringType()),
    ]
)

# Texts of pages that were recognised after their document was read, load by load.
RECOGNISED = T.StructType(
    [
        *PAGES,
        T.StructField("recognised_at", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

MIRROR = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("content", T.BinaryType()),
        T.StructField("loaded_at", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("year", T.IntegerType()),
    ]
)

# What a load returned: a row per key it was offered.
OUTCOME = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("batch_id", T.StringType()),
    ]
)

# Compact copies that a load reads instead of the growing tables: what is stored, by hash, and
# the newest state of each key.
HASHES = T.StructType([T.StructField("digest", T.BinaryType())])
STATES = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("error_msg", T.StringType()),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("first_at", T.TimestampType()),
        T.StructField("batch_id", T.StringType()),
    ]
)
