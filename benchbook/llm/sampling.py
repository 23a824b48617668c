"""A bounded sample of labelled texts to fit a classifier on, and its calibration."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchbook.llm.common import text_of


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    learn: Column,
    per_class: int,
    chars: int,
) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """``(text, label)`` of at most ``per_class`` documents of either label, and label counts.

    ``docs`` has ``doc_id, text``; ``labels`` has ``doc_id`` and ``label`` (0 or 1). Documents
    are chosen among the rows of ``labels`` for which ``learn`` holds, in the order of a hash of
    the id, so equal tables give equal samples. Of a longer text the sample holds a stretch of
    ``chars`` characters. At most ``2 * per_class * chars`` characters come to the driver. Null
    ids and labels are left out; of contradicting labels of one id the lower one counts. The
    counts are of all learnable labels. Only the chosen ids, a bounded list, are looked up in the
    documents, so the texts are not shuffled.
    """
    known = (
        labels.select("doc_id", F.col(label).cast("int").alias("y"))
        .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & learn)
        .groupBy("doc_id").agg(F.min("y").alias("y"))
    )
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    ids: dict = {}
    for y in (0, 1):
        chosen = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id")
        ids |= {r["doc_id"]: y for r in chosen.limit(per_class).collect()}
    if not ids:
        return [], counts
    spark = docs.sparkSession
    rows = list(ids.items())
    wanted = spark.createDataFrame(rows, f"doc_id {dict(docs.dtypes)['doc_id']}, y int")
    found = docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(wanted), "doc_id")
    at = F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - chars + 1, F.lit(1))) + 1
    part = found.select("doc_id", F.substr("text", at.cast("int"), F.lit(chars)).alias("text"), "y")
    sample = part.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * per_class).collect()
    return [(r["text"], r["y"]) for r in sample], counts


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-4) -> np.ndarray:
    """Weighted logistic regression by damped Newton steps; column 0 is the constant."""
    mean, spread = x.mean(axis=0), x.std(axis=0)
    mean[0], spread[spread == 0], spread[0] = 0, 1, 1
    z, w = (x - mean) / spread, w / w.sum()
    keep = np.full(x.shape[1], ridge)
    keep[0] = 0

    def loss(beta: np.ndarray) -> float:
        sign = np.where(y > 0.5, 1, -1)
        return float(w @ np.logaddexp(0, -sign * (z @ beta)) + 0.5 * keep @ beta**2)

    beta = np.zeros(x.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        slope = z.T @ (w * (y - p)) - keep * beta
        bend = (z * (w * p * (1 - p))[:, None]).T @ z + np.diag(keep + 1e-9)
        step, size = np.linalg.solve(bend, slope), 1.0
        while loss(beta + size * step) > loss(beta) and size > 1e-6:
            size /= 2
        beta = beta + size * step
        if np.abs(size * step).max() < 1e-7:
            break
    out = beta / spread
    out[0] = beta[0] - (beta[1:] * mean[1:] / spread[1:]).sum()
    return out
