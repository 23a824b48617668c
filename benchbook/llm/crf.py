"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals."""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchbook.llm.common import ready, slices, text_of
from benchbook.llm.sampling import labelled_sample, logistic

#: A chain ends at a sentence's last token, or after so many tokens.
CHAIN = 64
BUCKETS = 1 << 18
#: Beginnings of words, in bytes, that are features and may mark toxic documents like words do.
STEMS = (5, 6, 7)
_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _own(word: bytes) -> tuple[int, ...]:
    """Hashed features of a lower-cased token itself."""
    core = word.strip(_EDGE)
    parts = (
        b"bias", b"w" + core, b"t" + word[-3:], b"l%d" % min(len(core), 9),
        *[b"h%d" % n + core[:n] for n in STEMS],
    )
    return tuple(zlib.crc32(p) % BUCKETS for p in parts)


def _beside(word: bytes) -> tuple[int, int]:
    """Features that a token gives to the next and to the previous one."""
    core = word.strip(_EDGE)
    return zlib.crc32(b"p" + core) % BUCKETS, zlib.crc32(b"n" + core) % BUCKETS


def chains(ends: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of every chain. ``ends`` marks last tokens, ``sizes`` has tokens a text."""
    n = len(ends)
    first = np.zeros(n + 1, dtype=bool)
    first[1:] = ends
    first[np.cumsum(sizes)[np.cumsum(sizes) <= n]] = True
    first[0], first[n] = True, True
    starts = np.flatnonzero(first)
    spans = np.diff(starts)
    parts = -(-spans // CHAIN)
    begin = np.repeat(starts[:-1], parts)
    nth = np.arange(len(begin)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = begin + nth * CHAIN
    return begin, np.diff(np.append(begin, n))


def forward_backward(
    odds: np.ndarray, starts: np.ndarray, lengths: np.ndarray, stay: float, leave: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all chains at once: P(toxic) of each token, and of each token with its successor the
    probability of toxic-toxic and toxic-clean.

    Two tags need one number a step: the ratio of the two sums. ``odds`` is exp(score) of the
    toxic tag, ``stay`` and ``leave`` the potentials from toxic to toxic and to clean.
    """
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    ahead, behind = np.empty(len(odds)), np.ones(len(odds))
    longest = int(lengths[0]) if len(lengths) else 0
    active = [int(np.searchsorted(-lengths, -t, side="left")) for t in range(longest + 1)]
    if longest:
        ahead[starts] = odds[starts]
    for t in range(1, longest):
        at = starts[: active[t]] + t
        r = ahead[at - 1]
        ahead[at] = odds[at] * (r * stay + 1) / (r * leave + 1)
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        b = odds[at + 1] * behind[at + 1]
        behind[at] = (stay * b + leave) / (b + 1)
    both = ahead * behind
    inner = np.ones(len(odds), dtype=bool)
    inner[starts + lengths - 1] = False
    at = np.flatnonzero(inner)
    r, b = ahead[at], odds[at + 1] * behind[at + 1]
    total = r * stay * b + r * leave + b + 1
    return both / (1 + both), r * stay * b / total, r * leave / total


@dataclass(frozen=True)
class ToxicityModel:
    """Weights of the toxic tag by hashed feature, two transitions, and the calibration."""

    weights: np.ndarray
    stay: float
    leave: float
    calibration: tuple[float, ...]

    def tagger(self) -> Tagger:
        return Tagger(self)


class Tagger:
    """Scores texts with one model; keeps the scores of words seen, up to ``limit`` of them."""

    def __init__(self, model: ToxicityModel, limit: int = 600_000):
        self.model, self.limit = model, limit
        self.weights = model.weights.tolist()
        self._clear()

    def _clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.scores = np.empty((0, 4))

    def _learn(self, words: list[bytes]) -> None:
        w = self.weights
        rows = []
        for word in words:
            after, before = _beside(word)
            rows.append(
                (sum(w[i] for i in _own(word)), w[after], w[before], word[-1:] in b".!?")
            )
        self.index.update(zip(words, range(len(self.index), len(self.index) + len(words))))
        self.scores = np.vstack([self.scores, np.array(rows, dtype=float).reshape(-1, 4)])

    def marginals(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """P(toxic) of all tokens of all texts, and the number of tokens of each."""
        split = [t.encode().lower().split() for t in texts]
        words = list(itertools.chain.from_iterable(split))
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        if not words:
            return np.empty(0), sizes
        seen = set(words)
        if new := seen.difference(self.index):
            if len(self.index) + len(new) > self.limit:
                self._clear()
                new = seen
            self._learn(list(new))
        known = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        own, after, before, ends = self.scores.T[:, known]
        starts, lengths = chains(ends > 0, sizes)
        inner = np.ones(len(words), dtype=bool)
        inner[starts] = False
        score = own
        score[1:] += np.where(inner[1:], after[:-1], 0)
        score[:-1] += np.where(inner[1:], before[1:], 0)
        odds = np.exp(np.clip(score, -30, 30))
        return forward_backward(odds, starts, lengths, self.model.stay, self.model.leave)[0], sizes

    @staticmethod
    def features(marginals: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Per document: the strongest token, the expected number of toxic tokens, its share."""
        top, total = np.full(len(sizes), 1e-9), np.zeros(len(sizes))
        some = np.flatnonzero(sizes)
        if len(some):
            at = (np.cumsum(sizes) - sizes)[some]
            top[some] = np.clip(np.maximum.reduceat(marginals, at), 1e-9, 1 - 1e-9)
            total[some] = np.add.reduceat(marginals, at)
        return np.column_stack(
            [
                np.ones(len(sizes)), np.log(top / (1 - top)), np.log1p(total),
                np.log((total + 0.01) / (sizes + 1)),
            ]
        )

    def calibrated(self, features: np.ndarray) -> np.ndarray:
        z = features @ np.array(self.model.calibration)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _units(core: bytes) -> list[bytes]:
    """A word itself and its beginnings."""
    return [b"=" + core, *[b"^" + core[:n] for n in STEMS if len(core) > n]]


def seed_words(sample: list[tuple[str, int]], least: int = 3, ratio: float = 8.0,
               z: float = 5.0) -> set[bytes]:
    """Words and beginnings of words (``_units``) that mark toxic documents.

    Those that are in at least ``least`` of them, ``ratio`` times as often as in the others, and
    by ``z`` standard errors.
    """
    n = Counter(y for _, y in sample)

    def units(text: str) -> set[bytes]:
        cores = {w.strip(_EDGE) for w in text.encode().lower().split()} - {b""}
        return {u for core in cores for u in _units(core)}

    toxic: Counter[bytes] = Counter()
    for text, y in sample:
        if y == 1:
            toxic.update(units(text))
    toxic = Counter({u: k for u, k in toxic.items() if k >= least})
    clean: Counter[bytes] = Counter()  # of those units only
    for text, y in sample:
        if y == 0:
            clean.update(units(text) & toxic.keys())
    found = set()
    for unit, k in toxic.items():
        p, q = k / n[1], (clean[unit] + 0.5) / (n[0] + 1)
        pooled = (k + clean[unit] + 0.5) / (n[0] + n[1] + 1)
        error = (pooled * (1 - pooled) * (1 / n[1] + 1 / max(n[0], 1))) ** 0.5
        if p >= ratio * q and p - q >= z * error:
            found.add(unit)
    return found


def _is_seed(word: bytes, seeds: set[bytes]) -> bool:
    return not seeds.isdisjoint(_units(word.strip(_EDGE)))


def train_crf(
    tokens: list[list[bytes]], tags: list[np.ndarray], rounds: int = 80, ridge: float = 2e-3
) -> tuple[np.ndarray, float, float]:
    """Weights and transitions from labelled tokens (chains with a 0/1 tag a token), by Adam."""
    lengths = np.array([len(t) for t in tokens], dtype=np.int64)
    starts = np.cumsum(lengths) - lengths
    n = int(lengths.sum())
    truth = np.concatenate(tags).astype(float)
    index: dict[bytes, int] = {}
    table: list[tuple[int, ...]] = []
    for word in itertools.chain.from_iterable(tokens):
        if word not in index:
            index[word] = len(table)
            table.append((*_own(word), *_beside(word)))
    words = np.fromiter((index[w] for t in tokens for w in t), np.int64, n)
    rows = np.array(table, dtype=np.int32)[words]
    inner = np.ones(n, dtype=bool)
    inner[starts] = False
    own = rows[:, :-2]
    spare = BUCKETS  # a feature that counts for nothing
    after = np.full(n, spare, dtype=np.int32)
    after[1:] = np.where(inner[1:], rows[:-1, -2], spare)
    before = np.full(n, spare, dtype=np.int32)
    before[:-1] = np.where(inner[1:], rows[1:, -1], spare)
    # feature by feature, so that no table of all features of all tokens is made in a step
    features = [*np.ascontiguousarray(own.T), after, before]
    pairs = np.flatnonzero(np.append(inner[1:], False))
    seen = np.array(
        [(truth[pairs] * truth[pairs + 1]).sum(), (truth[pairs] * (1 - truth[pairs + 1])).sum()]
    )
    weights, moves = np.zeros(BUCKETS + 1), np.zeros(2)
    state = [np.zeros(BUCKETS + 3), np.zeros(BUCKETS + 3)]
    bias = int(own[0, 0])
    del words, rows, own
    weights[bias] = np.log((truth.sum() + 1) / (n - truth.sum() + 1))
    for step in range(1, rounds + 1):
        odds = np.exp(np.clip(sum(weights[f] for f in features), -30, 30))
        stay, leave = np.exp(moves)
        toxic, both, left = forward_backward(odds, starts, lengths, stay, leave)
        miss = toxic - truth
        slope = sum(np.bincount(f, miss, BUCKETS + 1) for f in features)
        slope[BUCKETS] = 0
        grad = np.append(slope, np.array([both.sum(), left.sum()]) - seen)
        grad += ridge * np.append(weights, moves) * max(truth.sum(), 1)
        state[0] = 0.9 * state[0] + 0.1 * grad
        state[1] = 0.99 * state[1] + 0.01 * grad**2
        move = 0.2 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.99**step)) + 1e-6)
        weights, moves = weights - move[:-2], np.clip(moves - move[-2:], -8, 8)
    return weights[:-1], float(np.exp(moves[0])), float(np.exp(moves[1]))


def _labelled_chains(sample, seeds, most_clean: int):
    """Chains of tokens with tags: seed words of toxic documents are toxic, all else is clean."""
    tokens, tags, clean = [], [], []
    for text, y in sample:
        words = text.encode().lower().split()
        ends = np.array([w[-1:] in b".!?" for w in words], dtype=bool)
        starts, lengths = chains(ends, np.array([len(words)])) if words else ((), ())
        for a, n in zip(starts, lengths):
            part = words[a : a + n]
            marked = np.array([_is_seed(w, seeds) for w in part], dtype=float)
            if marked.any():
                tokens.append(part)
                tags.append(marked * y)
            else:
                clean.append(part)
    step = max(1, -(-len(clean) // most_clean))
    for part in clean[::step]:
        tokens.append(part)
        tags.append(np.zeros(len(part)))
    return tokens, tags


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    label: str = "toxic",
    per_class: int = 2000,
    chars: int = 16_000,
    clean_chains: int = 20_000,
) -> ToxicityModel:
    """Fit on a bounded sample: ``per_class`` documents of either label, ``chars`` of each, and of
    their chains without a marked word at most ``clean_chains``, taken at even steps.

    Token labels come from the document labels (``seed_words``). Two thirds of the sample train
    the field, the rest calibrates document scores, weighted back to the share of each label.
    Without labels of one kind the score is the share of label 1 (0.5 if there is none at all).
    """
    ready(docs.sparkSession)
    learn = F.lit(True) if learn is None else learn
    sample, counts = labelled_sample(docs, labels, label, learn, per_class, chars)
    total = sum(counts.values())
    share = min(max(counts.get(1, 0) / total, 1e-6), 1 - 1e-6) if total else 0.5
    flat = (float(np.log(share / (1 - share))), 0.0, 0.0, 0.0)
    empty = ToxicityModel(np.zeros(BUCKETS), 1.0, 1.0, flat)
    by = [[s for s in sample if s[1] == y] for y in (0, 1)]
    fit = [s for part in by for i, s in enumerate(part) if i % 3]
    rest = [s for part in by for i, s in enumerate(part) if i % 3 == 0]
    if not all(any(y == k for _, y in part) for part in (fit, rest) for k in (0, 1)):
        return empty
    tokens, tags = _labelled_chains(fit, seed_words(fit), clean_chains)
    if not tokens:
        return empty
    model = ToxicityModel(*train_crf(tokens, tags), flat)
    tagger = model.tagger()
    features = tagger.features(*tagger.marginals([t for t, _ in rest]))
    y = np.array([y for _, y in rest], dtype=float)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    beta = logistic(features, y, weight)
    return ToxicityModel(model.weights, model.stay, model.leave, tuple(map(float, beta)))


def _spans(text: str, marginals: np.ndarray, least: float) -> list[dict]:
    """Code point spans of the tokens with at least this probability, neighbours joined."""
    hits = np.flatnonzero(marginals >= least)
    if not len(hits):
        return []
    wanted, out, last = set(hits.tolist()), [], -2
    for i, m in enumerate(_TOKEN.finditer(text)):
        if i in wanted:
            p = float(marginals[i])
            if i == last + 1:
                out[-1] = {"start": out[-1]["start"], "end": m.end(),
                           "probability": max(p, out[-1]["probability"])}
            else:
                out.append({"start": m.start(), "end": m.end(), "probability": p})
            last = i
            if i == hits[-1]:
                break
    return out


_SPANS = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])
)


def score_toxicity(df: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score",
                   spans: str = "spans", least: float = 0.5) -> DataFrame:
    """Add a document score from 0 to 1 and the toxic spans, judged by the whole text alone.

    Per row, no shuffle; the model is a few MB of a fixed size and sent to the tasks once. Tokens
    are runs without ASCII white space. A null text scores as an empty one and has no spans.
    Columns of the frame with the names of the results are replaced. An empty table stays empty.
    """
    spark = ready(df.sparkSession)
    fields = [f for f in df.schema.fields if f.name not in (score, spans)]
    names = [f.name for f in fields]
    span = T.StructType(
        [
            T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
            T.StructField("probability", T.DoubleType()),
        ]
    )
    schema = T.StructType(
        [*fields, T.StructField(score, T.DoubleType()), T.StructField(spans, T.ArrayType(span))]
    )
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shared.value.tagger()
        for whole in batches:
            for batch in slices(whole, text):
                texts = [t or "" for t in batch.column(text).to_pylist()]
                found, sizes = tagger.marginals(texts)
                scores = tagger.calibrated(tagger.features(found, sizes))
                cuts = np.cumsum(sizes)
                listed = [
                    _spans(t, found[b - n : b], least) for t, b, n in zip(texts, cuts, sizes)
                ]
                columns = [
                    *batch.columns, pa.array(scores, type=pa.float64()), pa.array(listed, type=_SPANS)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, score, spans])

    return df.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, schema)


def toxicity_report(docs: DataFrame, model: ToxicityModel, held_out: Column) -> DataFrame:
    texts = docs.select("doc_id", text_of("text").alias("text"))
    scored = score_toxicity(texts, model).select("doc_id", "score", "spans")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans",
    )
