"""Quality classifier: which of two compression dictionaries, good or bad, fits a text better."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchbook.llm.common import ready, slices, text_of
from benchbook.llm.sampling import labelled_sample, logistic


def pieces(text: str, size: int) -> list[bytes]:
    """The whole text in pieces, each compressed for itself: the dictionary then counts alike in
    short and long texts, as no piece grows past it."""
    data = text.encode()
    return [data[at : at + size] for at in range(0, len(data), size)]


def _dictionary(texts: list[str], piece: int, size: int) -> bytes:
    samples = [p for t in texts for p in pieces(t, piece)]
    if sum(map(len, samples)) > 2 * size and len(samples) > 100:
        try:
            return zstandard.train_dictionary(size, samples).as_bytes()
        except zstandard.ZstdError:
            pass  # too little variety to train on: take the samples as they are
    return b"".join(samples)[:size]


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the calibration of what they say."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    piece: int = 500
    level: int = 3

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for data in (self.good, self.bad):
            found = zstandard.ZstdCompressionDict(data) if data else None
            if found:
                found.precompute_compress(level=self.level)
            made.append(
                zstandard.ZstdCompressor(
                    level=self.level, dict_data=found, write_content_size=False,
                    write_checksum=False, write_dict_id=False,
                )
            )
        return made

    def sizes(self, texts: list[str]) -> np.ndarray:
        """Bytes of every text: with the good dictionary, with the bad one, as it is."""
        good, bad = (c.compress for c in self.compressors())
        out = np.zeros((len(texts), 3))
        for i, text in enumerate(texts):
            parts = pieces(text, self.piece)
            out[i] = sum(len(good(p)) for p in parts), sum(len(bad(p)) for p in parts), sum(
                map(len, parts)
            )
        return out

    @staticmethod
    def features(sizes: np.ndarray) -> np.ndarray:
        """The normalised size difference, how far the text compresses at all, their squares."""
        good, bad, plain = sizes.T
        gap = (bad - good) / np.maximum(np.maximum(good, bad), 1)
        fit = np.log((np.minimum(good, bad) + 8) / (plain + 8))
        short = 1 / np.sqrt(plain + 8)
        return np.column_stack([np.ones(len(gap)), gap, gap**2, fit, fit**2, gap * fit, short])

    def scores(self, texts: list[str]) -> np.ndarray:
        return self.calibrated(self.sizes(texts))

    def calibrated(self, sizes: np.ndarray) -> np.ndarray:
        z = self.features(sizes) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    label: str = "quality",
    per_class: int = 3000,
    chars: int = 8000,
    dictionary_bytes: int = 110_000,
) -> QualityModel:
    """Fit on a bounded sample: ``per_class`` documents of either label, ``chars`` of each.

    The sample makes the dictionaries; what calibrates is each half as seen by dictionaries of the
    other, weighted back to the share of each label. Without any label of one kind the score is the share of label 1 (0.5
    if there is no label at all).
    """
    ready(docs.sparkSession)
    learn = F.lit(True) if learn is None else learn
    sample, counts = labelled_sample(docs, labels, label, learn, per_class, chars)
    total = sum(counts.values())
    share = min(max(counts.get(1, 0) / total, 1e-6), 1 - 1e-6) if total else 0.5
    flat = (float(np.log(share / (1 - share))), *[0.0] * 6)
    by = {y: [t for t, found in sample if found == y] for y in (0, 1)}
    if not by[0] or not by[1]:
        return QualityModel(b"", b"", flat)

    def trained(keep: slice) -> QualityModel:
        bad, good = (_dictionary(by[y][keep], QualityModel.piece, dictionary_bytes) for y in (0, 1))
        return QualityModel(good, bad, flat)

    # each half is judged by the dictionaries of the other half
    sizes, truth = [], []
    halves = slice(0, None, 2), slice(1, None, 2)
    for own, other in (halves, halves[::-1]):
        if by[0][own] and by[1][own]:
            model = trained(own)
            for y in (0, 1):
                sizes.append(model.sizes(by[y][other]))
                truth += [y] * len(by[y][other])
    model, y = trained(slice(None)), np.array(truth, dtype=float)
    if not truth or not 0 < y.sum() < len(y):
        return model
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    beta = logistic(model.features(np.vstack(sizes)), y, weight)
    return QualityModel(model.good, model.bad, tuple(map(float, beta)))


def score_quality(df: DataFrame, model: QualityModel, text: str = "text",
                  score: str = "score") -> DataFrame:
    """Add the probability that a text is of label 1, judged by its whole text alone.

    Per row, no shuffle. A null text scores as an empty one. A column of the frame with the name
    of the result is replaced. An empty table stays empty.
    """
    ready(df.sparkSession)
    fields = [f for f in df.schema.fields if f.name != score]
    names = [f.name for f in fields]
    schema = T.StructType([*fields, T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                found = model.scores([t or "" for t in batch.column(text).to_pylist()])
                columns = [*batch.columns, pa.array(found, type=pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, score])

    return df.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, schema)


def quality_report(docs: DataFrame, model: QualityModel, held_out: Column) -> DataFrame:
    texts = docs.select("doc_id", text_of("text").alias("text"))
    scored = score_quality(texts, model).select("doc_id", "score")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
