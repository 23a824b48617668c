"""From text to the full extracted record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchbook import schema
from benchbook.functions import bench, caseline, citations, narrative, normalize, parties, quality
from benchbook.functions.regex import folded
from benchbook.session import once_per_session


#: Version of the rules that derive the fields. Raise it with a change of any of them: loads of an
#: older version are then derived anew by ``store.reextract``.
EXTRACTOR = 1


def with_lower(df: DataFrame, text: str = "full_text") -> DataFrame:
    """Add the lower-cased text as a column, so that it is made once per text."""
    return df.withColumn("_lower", F.lower(F.col(text)))


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that a later filter reads instead of computing again.

    A filter on a plain projected column is moved below the projection together with the whole
    expression, which for texts means doing the work twice; it stays above a generator.
    """
    row = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(row)))


@once_per_session
def _quality_columns(text: str) -> dict[str, Column]:
    return {
        "content_hash": quality.content_hash(F.col(text)),
        "quality_score": quality.quality_score(F.col(text), F.col("_lower")),
    }


def with_quality(df: DataFrame, text: str = "full_text") -> DataFrame:
    """Add ``content_hash`` and ``quality_score``: all the gate and the dedup need."""
    return compute_once(with_lower(df, text), _quality_columns(text)).drop("_lower")


@once_per_session
def _metadata_steps(text: str, key: str) -> tuple[dict[str, Column], ...]:
    body, end, low = F.col(text), F.col("_span")["end"], F.col("_low")
    windows = {
        "_low": folded(F.col("_lower")),
        "_header": normalize.collapsed_header(body),
        "_span": bench.bench_span(body),
        "_sides": parties.sides(normalize.header_lines(body)),
    }
    independent = {
        "_case": caseline.case_line(F.col("_header")),
        "judgment_date": caseline.judgment_date(F.col("_header")),
        "bench": bench.bench_names(body, F.col("_span")),
    }
    dependent = {
        "case_type": F.col("_case")["case_type"],
        "case_number": F.col("_case")["case_number"],
        "year": caseline.resolved_year(
            F.col("judgment_date"), F.col(key), F.col("_case")["case_year"]
        ),
        "petitioner": parties.petitioner(F.col("_sides")),
        "respondent": parties.respondent(F.col("_sides")),
        "title": parties.title(F.col("_sides")),
        "cases_cited": citations.cases_cited(body, low),
        "acts_cited": citations.acts_cited(body, low),
        "result": narrative.result(body, low),
        "summary": narrative.summary(body, low, end),
        "tags": narrative.tags(body, low, end),
        "holding": narrative.holding(body, low),
        "applicability": bench.applicability(F.col("bench")),
    }
    return windows, independent, dependent


def with_metadata(df: DataFrame, text: str = "full_text", key: str = "key") -> DataFrame:
    """Add every derived field of a judgment to cleaned texts.

    Three projections, no shuffle: shared windows first, then the fields that read them, then
    the fields that read other fields. A column used more than once is its own step, so that it
    is computed once.
    """
    df = with_lower(df, text)
    for step in _metadata_steps(text, key):
        df = df.withColumns(step)
    return df.drop("_lower", "_low", "_header", "_span", "_sides", "_case")


def extract_record(df: DataFrame, text: str = "full_text", key: str = "key") -> DataFrame:
    """Cleaned texts to the fixed record, one row per input row, keyed by ``pdf_s3_key``."""
    full = with_metadata(with_quality(df, text), text, key)
    renamed = {"full_text": F.col(text), "pdf_s3_key": F.col(key)}
    return full.select(
        *[renamed.get(name, F.col(name)).alias(name) for name in schema.RECORD.names]
    )


def reparse(stored: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Derive the record again from stored rows, without reading the source objects.

    Hash and score are of the same text and stay as they are stored, like the columns ``keep``.
    """
    kept = stored.select(
        "full_text", "content_hash", "quality_score", F.col("pdf_s3_key").alias("key"), *keep
    )
    full = with_metadata(kept).withColumnRenamed("key", "pdf_s3_key")
    return full.select(*schema.RECORD.names, *keep)


def with_provenance(df: DataFrame, endpoint: str, bucket: str, key: str = "key") -> DataFrame:
    """Add the object key and the address of its mirrored copy."""
    return df.withColumns(
        {
            "pdf_s3_key": F.col(key),
            "source_url": F.concat(F.lit(f"{endpoint}/{bucket}/"), F.col(key)),
        }
    )
