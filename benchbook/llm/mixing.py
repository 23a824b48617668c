"""Mixing to target weights: raking of token weights to several marginals, then sampling."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchbook.llm.common import text_of, unused

#: Stands for every value that a marginal does not name, null included.
OTHER = "*"


def word_count(text: str) -> Column:
    """Words of a text, the token count used for mixing."""
    return F.regexp_count(text_of(text), F.lit(r"\S+")).cast("long")


def layout_topic(text: str, words: Column) -> Column:
    """A stand-in topic for tables without one: how a text is laid out."""
    body = text_of(text)
    lines = F.length(body) - F.length(F.translate(body, "\n", "")) + 1
    return (
        F.when(words == 0, "empty")
        .when(words < 50, "snippet")
        .when(words / lines < 12, "list")
        .when(words < 400, "note")
        .otherwise("article")
    )


@dataclass(frozen=True)
class Raked:
    """Result of raking: expected tokens of each cell, sweeps done, largest error of a marginal."""

    expected: np.ndarray
    sweeps: int
    error: float


def rake(
    cells: list[tuple[str, ...]], tokens: np.ndarray, targets: list[dict[str, float]], total: float,
    sweeps: int = 500, tolerance: float = 1e-6,
) -> Raked:
    """Iterative proportional fitting of ``tokens`` to ``targets`` (shares) times ``total``.

    A cell never gets more than it has, as no document is taken twice. What a full cell cannot
    give is asked of the others in the next sweep. Marginals that contradict each other pull to
    and fro without end; the result is then the mean of what each of them asks for, if that is
    closer to all.
    """
    ids, wanted = [], []
    for axis, shares in enumerate(targets):
        names = sorted({cell[axis] for cell in cells})
        place = {name: i for i, name in enumerate(names)}
        ids.append(np.array([place[cell[axis]] for cell in cells], dtype=np.int64))
        wanted.append(np.array([shares[name] for name in names]) * total)
    free = tokens * (total / max(tokens.sum(), 1e-300))
    expected, error, sweep = np.minimum(free, tokens), np.inf, 0

    def error_of(values: np.ndarray) -> float:
        return max(
            float(np.abs(np.bincount(at, values, len(want)) - want).max()) / max(total, 1e-300)
            for at, want in zip(ids, wanted)
        )

    for sweep in range(1, sweeps + 1):
        asked = []
        for at, want in zip(ids, wanted):
            full = expected >= tokens * (1 - 1e-12)
            held = np.bincount(at, np.where(full, expected, 0), len(want))
            open_ = np.bincount(at, np.where(full, 0, expected), len(want))
            factor = np.where(open_ > 0, np.maximum(want - held, 0) / np.maximum(open_, 1e-300), 1)
            over = held > want  # then full cells give as well
            now = np.bincount(at, expected, len(want))
            share = np.where(now > 0, want / np.maximum(now, 1e-300), 1)
            scale = np.where(over[at], share[at], np.where(full, 1, factor[at]))
            expected = np.minimum(expected * scale, tokens)
            asked.append(expected)
        error = error_of(expected)
        if error <= tolerance:
            break
    else:
        mean = np.mean(asked, axis=0) if sweeps else expected
        if error_of(mean) < error:
            expected, error = mean, error_of(mean)
    return Raked(expected, sweep, error)


def shares_of(asked: dict[str, float], observed: dict[str, float]) -> dict[str, float]:
    """Shares of all values that occur: those asked for, the rest for what is not named.

    ``OTHER`` may be asked for like a value; if it is not, it keeps its observed share. Values
    that do not occur give theirs up to the others in proportion.
    """
    total = sum(observed.values())
    found = {k: asked[k] for k in observed if k in asked}
    if OTHER in observed and OTHER not in asked:
        rest = observed[OTHER] / total if total else 0.0
        scale = (1 - rest) / (sum(found.values()) or 1.0)
        found = {k: v * scale for k, v in found.items()} | {OTHER: rest}
    whole = sum(found.values())
    if whole <= 0:
        return {k: (v / total if total else 0.0) for k, v in observed.items()}
    return {k: v / whole for k, v in found.items()}


def largest_total(cells, tokens, targets, slack: float) -> tuple[float, Raked]:
    """The most tokens that can be kept with every marginal within ``slack`` of its share.

    Marginals that contradict each other give way to those of their closest fit, at a total so
    small that no cell is full; ``error`` stays the difference from the asked ones.
    """
    low, high = 0.0, float(tokens.sum())
    best = rake(cells, tokens, targets, high)
    if best.error <= slack:
        return high, best
    low = total = 1e-6 * high
    best = closest = rake(cells, tokens, targets, total)
    met = targets
    if closest.error > slack:
        met = [_shares(cells, closest.expected, axis) for axis in range(len(targets))]
    for _ in range(18):
        middle = (low + high) / 2
        found = rake(cells, tokens, met, middle)
        if found.error <= slack:
            low, total, best = middle, middle, found
        else:
            high = middle
    if met is not targets:
        got = [_shares(cells, best.expected, axis) for axis in range(len(targets))]
        off = max(abs(g.get(k, 0.0) - v) for g, t in zip(got, targets) for k, v in t.items())
        best = Raked(best.expected, best.sweeps, off)
    return total, best


def _shares(cells, values: np.ndarray, axis: int) -> dict[str, float]:
    out: dict[str, float] = {}
    for cell, value in zip(cells, values):
        out[cell[axis]] = out.get(cell[axis], 0.0) + float(value)
    whole = sum(out.values()) or 1.0
    return {k: v / whole for k, v in out.items()}


def mix_documents(
    docs: DataFrame,
    targets: dict[Column | str, dict[str, float]] | list[tuple[Column, dict[str, float]]],
    tokens: Column,
    keep: float | None = None,
    seed: int = 0,
    slack: float = 0.002,
    text: str = "text",
    doc_id: str = "doc_id",
) -> DataFrame:
    """Add ``tokens, weight, probability, kept, mix_error`` to every document.

    ``targets`` lists ``(column, {value: share})``. ``weight`` is the raked token weight of the
    document's cell against its plain share, ``probability`` its chance to be kept, ``kept`` the
    draw: a hash of seed, id and text against the probability, so equal tables give equal samples
    and repeated rows share their fate. The sample has ``keep`` of all tokens, or, by default, as
    many as the marginals allow within ``slack``. ``mix_error``, one number for all rows, is the
    largest difference that a marginal of the fit has from its target share: above ``slack`` the
    marginals contradict each other, and the sample is the largest one with the marginals of
    their closest fit (or ``keep`` asks for more than they allow).

    Two passes over the documents without a shuffle of texts: one sums the tokens by cell,
    combined in every task, the other looks the cell up. Cells are at most the product of the
    sizes of the marginals as the caller wrote them (values not named are one value, null
    among them), which bounds what is fitted on the driver and broadcast back, whatever the
    number of documents or of sources. Columns named like a result are replaced. A
    document without tokens has the chance of its cell, and is kept if none in it has any. An
    empty table gives no rows.
    """
    listed = list(targets.items()) if isinstance(targets, dict) else targets
    listed = [(F.col(c) if isinstance(c, str) else c, shares) for c, shares in listed]
    results = ("tokens", "weight", "probability", "kept", "mix_error")
    names = [c for c in docs.columns if c not in results]
    keys = [unused(docs, f"_cell{i}") for i in range(len(listed))]
    own = unused(docs, "_tokens")
    spark = docs.sparkSession

    def pooled(value: Column, shares: dict[str, float]) -> Column:
        known = value.cast("string").isin([k for k in shares if k != OTHER])
        return F.when(known, value.cast("string")).otherwise(OTHER)

    counted = docs.select(
        *[F.col(f"`{c}`") for c in names], tokens.cast("long").alias(own),
        *[pooled(value, shares).alias(key) for key, (value, shares) in zip(keys, listed)],
    )
    rows = counted.groupBy(*keys).agg(F.sum(own).alias("_n")).filter("_n > 0").collect()
    rows = sorted(rows, key=lambda r: tuple(r[k] for k in keys))
    cells = [tuple(r[k] for k in keys) for r in rows]
    sums = np.array([float(r["_n"]) for r in rows])
    fitted, error = [], 0.0
    if cells:
        shares = []
        for axis, (_, asked) in enumerate(listed):
            observed: dict[str, float] = {}
            for cell, n in zip(cells, sums):
                observed[cell[axis]] = observed.get(cell[axis], 0.0) + n
            shares.append(shares_of(asked, observed))
        if keep is None:
            total, found = largest_total(cells, sums, shares, slack)
        else:
            total = keep * sums.sum()
            found = rake(cells, sums, shares, total)
        error = found.error
        chance = np.clip(found.expected / sums, 0, 1)
        weight = chance * sums.sum() / max(total, 1e-300)
        fitted = [(*c, float(w), float(p)) for c, w, p in zip(cells, weight, chance)]
    fields = ", ".join([*[f"{k} string" for k in keys], "weight double", "probability double"])
    plan = F.broadcast(spark.createDataFrame(fitted, fields))
    # 52 bits of a hash, as a number from 0 to 1
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text)), 12) / F.lit(
        float(1 << 52)
    )
    chance = F.coalesce("probability", F.lit(1.0))
    return counted.join(plan, keys, "left").select(
        *[F.col(f"`{c}`") for c in names],
        F.col(own).alias("tokens"),
        F.coalesce("weight", F.lit(1.0)).alias("weight"),
        chance.alias("probability"),
        (draw < chance).alias("kept"),
        F.lit(float(error)).alias("mix_error"),
    )


#: Target shares of the tokens in the standard mix; what is not named keeps its share.
SOURCE_TARGETS = {"src0": 0.24} | {f"src{i}": 0.04 for i in range(1, 20)}
LANG_TARGETS = {"en": 0.6, "de": 0.15, "fr": 0.15, "es": 0.1}
TOPIC_TARGETS = {"article": 0.75, "note": 0.25}


def standard_mix(docs: DataFrame) -> DataFrame:
    """``mix_documents`` of a table like ``documents`` to the standard targets."""
    words = word_count("text")
    targets = [
        (F.col("source"), SOURCE_TARGETS), (F.col("lang"), LANG_TARGETS),
        (layout_topic("text", words), TOPIC_TARGETS),
    ]
    return mix_documents(docs, targets, words)


def sampled(docs: DataFrame) -> DataFrame:
    """The documents that the standard mix keeps, with their own columns only."""
    inner = docs.select("doc_id", "text", "source", "lang", F.struct("*").alias("row"))
    return standard_mix(inner).filter("kept").select("row.*")
