"""From documents to packed training sequences, one operator of ``benchbook.llm`` a stage.

Every stage is a function of the session, the documents its predecessor kept, and the folder of
the tables; its result is written and read again as the next one's documents. All but the last
return the columns that came in, extra ones included, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benchbook.llm import compression, jaccard, mixing, packing, secret_scan
from benchbook.llm.common import remainder, stage, table, unused


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier takes for good ones (score of 0.5 or more).

    It learns from the same rows as the registered query. Null texts are judged like empty ones.
    """
    labels = table(spark, sf_dir, "labels")
    model = compression.fit_quality(docs, labels, learn=remainder("doc_id", 3) != 1)
    score = unused(docs, "score")
    scored = compression.score_quality(docs, model, score=score)
    return scored.filter(F.col(score) >= 0.5).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the smallest id."""
    return jaccard.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return secret_scan.without_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with the target shares of sources, languages and topics."""
    return mixing.sampled(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in training sequences."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mix", mix),
    ("pack", pack),
]

#: Compression and set similarity have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents, each written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
