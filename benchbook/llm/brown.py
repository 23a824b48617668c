"""Language-model scores from a class-based bigram model with classes found by exchange.

Exchange finds the classes of units: the most frequent words, and spelling types that stand for all
other words meanwhile. Then every further word of the corpus gets the class that makes its own
neighbours most likely, in one grouping of the words by their neighbours' classes; so the clustered
vocabulary grows with the corpus. Only words never seen have the class of their spelling. P(w | v) = (c(w) + k) * (share * P(class of w | class of v) / mass of the
class + (1 - share) / mass of all): the class model mixed with word frequencies. Counts and classes
of frequent words are known where a text is read; those of others come from one join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchbook.llm.common import lengths, ready, slices, stage, text_of
from benchbook.llm.words import Spelled

#: Hash of the end of a text. No word has it: words are hashed with xxHash, and 0 is not counted.
END = 0
#: Bytes of text counted at once in Python; Spark sums what the parts of a task give.
PART = 6_000_000


def word_counts(texts: DataFrame, types: int) -> DataFrame:
    """``hash, spelling, n`` of all words of ``text``, ends of texts among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", PART):
                words = Spelled.of(batch.column("text"), types)
                n = np.bincount(words.at, minlength=len(words.hash))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.append(words.hash.view(np.int64), END)),
                        pa.array(np.append(words.spelling, 0).astype(np.int32)),
                        pa.array(np.append(n, batch.num_rows)),
                    ],
                    names=["hash", "spelling", "n"],
                )

    found = texts.select("text").mapInArrow(run, "hash long, spelling int, n long")
    return found.groupBy("hash", "spelling").agg(F.sum("n").alias("n")).filter("n > 0")


@dataclass(frozen=True)
class Units:
    """Hashes of the frequent words (the end first), and spelling types for all others."""

    core: np.ndarray  # uint64, sorted
    unit: np.ndarray  # unit of each of them
    types: int

    @property
    def number(self) -> int:
        return len(self.core) + self.types

    @property
    def end(self) -> int:
        return int(self.unit[np.searchsorted(self.core, np.uint64(END))])

    def of(self, hashes: np.ndarray, spelling: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.core, hashes), len(self.core) - 1)
        return np.where(self.core[at] == hashes, self.unit[at], len(self.core) + spelling)


def _with_ends(values: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The values of each text with ``end`` after them."""
    return np.insert(values, np.cumsum(sizes), end)


def unit_pairs(texts: DataFrame, units: Units) -> DataFrame:
    """``p, q, n``: how often unit ``q`` follows ``p``; texts begin after an end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", PART):
                words = Spelled.of(batch.column("text"), units.types)
                own = units.of(words.hash, words.spelling)[words.at]
                after = _with_ends(own, words.sizes, units.end)
                before = np.append(units.end, after[:-1])
                code, n = np.unique(before * units.number + after, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((code // units.number).astype(np.int32)),
                        pa.array((code % units.number).astype(np.int32)), pa.array(n),
                    ],
                    names=["p", "q", "n"],
                )

    found = texts.select("text").mapInArrow(run, "p int, q int, n long")
    return found.groupBy("p", "q").agg(F.sum("n").alias("n"))


def contexts(pairs: DataFrame) -> DataFrame:
    """One row a unit and side: the units before it (side 0) or after it (1), with counts.

    A row has at most as many entries as there are units, so no group is unbounded.
    """
    both = pairs.select(F.col("q").alias("unit"), F.lit(0).alias("side"), F.col("p").alias("c"), "n")
    both = both.union(pairs.select("p", F.lit(1), "q", "n"))
    listed = F.collect_list(F.struct("c", "n")).alias("l")
    return both.groupBy("unit", "side").agg(listed).select(
        "unit", "side", F.col("l.c").alias("c"), F.col("l.n").alias("n")
    )


def class_contexts(table: DataFrame, units: int, classes: np.ndarray, k: int) -> np.ndarray:
    """Counts of classes before and after each unit, itself left out, and of itself after itself.

    ``(2, units, k + 1)``: of a size set by the model, not by the corpus.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for unit, c, n in zip(batch.column("unit").to_pylist(), batch.column("c"),
                                  batch.column("n")):
                c, n = c.values.to_numpy(), n.values.to_numpy().astype(np.float64)
                own = c == unit
                row = np.append(
                    np.bincount(classes[c], np.where(own, 0, n), k), n[own].sum()
                )
                rows.append(row.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("unit"), batch.column("side"), pa.array(rows, pa.binary())],
                names=["unit", "side", "counts"],
            )

    out = np.zeros((2, units, k + 1))
    for r in table.mapInArrow(run, "unit int, side int, counts binary").toLocalIterator():
        out[r["side"], r["unit"]] = np.frombuffer(bytes(r["counts"]))
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-9))


def exchange(counts: np.ndarray, classes: np.ndarray, k: int, order: np.ndarray) -> np.ndarray:
    """One sweep: every unit, frequent ones first, goes to the class that makes the class bigrams
    most likely. Class counts follow each move; contexts are those of the sweep's start."""
    classes = classes.copy()
    before, after = counts[0, :, :k], counts[1, :, :k]
    twice = counts[1, :, k]
    table = np.zeros((k, k))
    np.add.at(table, classes, after)
    np.add.at(table, (classes, classes), twice)
    mass = table.sum(axis=1)
    diagonal = np.arange(k)
    for u in order:
        r, l, s = after[u], before[u], twice[u]
        n = r.sum() + s
        if n + l.sum() == 0:
            continue
        g = classes[u]
        table[g] -= r
        table[:, g] -= l
        table[g, g] -= s
        np.maximum(table, 0, out=table)
        mass[g] -= n
        gain = (_xlogx(table + r) - _xlogx(table)).sum(axis=1)
        gain += (_xlogx(table.T + l) - _xlogx(table.T)).sum(axis=1)
        # the cell of a class with itself takes both sides and the unit's own pairs
        cell = table[diagonal, diagonal]
        gain += _xlogx(cell + r + l + s) - _xlogx(cell + r) - _xlogx(cell + l) + _xlogx(cell)
        gain -= 2 * (_xlogx(mass + n) - _xlogx(mass))
        h = int(np.argmax(gain))
        classes[u] = h
        table[h] += r
        table[:, h] += l
        table[h, h] += s
        mass[h] += n
    return classes


def word_contexts(texts: DataFrame, units: Units, classes: np.ndarray, k: int) -> DataFrame:
    """``hash, code, n``: neighbours of every word that is no frequent one, by class.

    A code is the word's spelling type, then what stands before it and what after it, both in base
    ``2k``: the class of a frequent word or the end, from ``k`` on that of a spelling type.
    """
    label = classes + k * (np.arange(units.number) >= len(units.core))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", PART):
                words = Spelled.of(batch.column("text"), units.types)
                unit = units.of(words.hash, words.spelling)[words.at]
                row = _with_ends(np.where(unit < len(units.core), -1, words.at), words.sizes, -1)
                of = _with_ends(label[unit], words.sizes, label[units.end])
                at = np.flatnonzero(row >= 0)
                before = np.append(label[units.end], of[:-1])[at]
                # an end follows the last word of every text
                pair = before * (2 * k) + of[at + 1]
                code, n = np.unique(row[at] * (4 * k * k) + pair, return_counts=True)
                word = code // (4 * k * k)
                code += (words.spelling[word] - word) * (4 * k * k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.hash[word].view(np.int64)), pa.array(code), pa.array(n)],
                    names=["hash", "code", "n"],
                )

    return texts.select("text").mapInArrow(run, "hash long, code long, n long")


def assign(
    neighbours: DataFrame, of_type: np.ndarray, gains: np.ndarray, own_from: int
) -> DataFrame:
    """``hash, n, class, code``: the class of every word of ``word_contexts``, and its count.

    A word seen at least ``own_from`` times goes to the class of the largest sum of ``gains`` (by
    neighbour, those before a word first, and class) over its neighbours, any other to ``of_type``
    of its spelling. Rows with a code and no hash add up the neighbours of a class; codes after the
    last one count its words' tokens by the class of their spelling. One task yields a number of
    these that the model sets.

    A word outside the frequent ones is a small part of all, and has at most one entry a code.
    """
    codes, k = gains.shape
    half, wide = codes // 2, codes + k
    grouped = (
        neighbours.repartition("hash").groupBy("hash", "code").agg(F.sum("n").alias("n"))
        .groupBy("hash").agg(F.collect_list(F.struct("code", "n")).alias("l"))
        .select("hash", F.col("l.code").alias("code"), F.col("l.n").alias("n"))
    )
    names = ["hash", "n", "class", "code"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, wide))
        for whole in batches:
            for start in range(0, whole.num_rows, 4096):
                batch = whole.slice(start, 4096)
                rows = batch.num_rows
                per = lengths(batch.column("code"))
                place = np.repeat(np.arange(rows), per)
                code = batch.column("code").flatten().to_numpy()
                times = batch.column("n").flatten().to_numpy().astype(np.float64)
                before, after = code // half % half, half + code % half
                seen = np.bincount(place * codes + before, times, rows * codes)
                seen += np.bincount(place * codes + after, times, rows * codes)
                n = np.bincount(place, times, rows)
                spelled = of_type[code[np.cumsum(per) - per] // (half * half)]
                best = np.argmax(seen.reshape(rows, codes) @ gains, axis=1)
                found = np.where(n >= own_from, best, spelled)
                for at, times_at in (
                    (found[place] * wide + before, times), (found[place] * wide + after, times),
                    (found * wide + codes + spelled, n),
                ):
                    sums += np.bincount(at, times_at, k * wide).reshape(k, wide)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("hash"), pa.array(n.astype(np.int64)),
                        pa.array(found.astype(np.int32)), pa.nulls(rows, pa.int32()),
                    ],
                    names=names,
                )
        of, code = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(len(of), pa.int64()), pa.array(sums[of, code].astype(np.int64)),
                pa.array(of.astype(np.int32)), pa.array(code.astype(np.int32)),
            ],
            names=names,
        )

    return grouped.mapInArrow(run, "hash long, n long, class int, code int")


@dataclass(frozen=True)
class ClassModel:
    """All that scoring needs besides counts and classes of rare words; its size is set by
    parameters."""

    of_type: np.ndarray  # class by spelling type, for words without one of their own
    end_class: int
    log_bracket: np.ndarray  # log10 of the factor for class of word after class of word before
    top: np.ndarray  # sorted hashes of words whose counts and classes are sent along
    top_counts: np.ndarray
    top_classes: np.ndarray
    tokens: int  # N
    distinct: int  # V
    k: float

    def columns(self, hashes: np.ndarray) -> list[np.ndarray]:
        """Class and count of words, -1 where they are not sent along."""
        at = np.minimum(np.searchsorted(self.top, hashes), len(self.top) - 1)
        sent = self.top[at] == hashes
        return [
            np.where(sent, self.top_classes[at], -1), np.where(sent, self.top_counts[at], -1),
        ]

    @property
    def base_mass(self) -> float:
        return self.tokens + self.k * (self.distinct + 1)


def _at_least(counts: DataFrame, most: int) -> int:
    """Smallest count that at most ``most`` words reach, to one part in eight."""
    step = F.when(F.col("n") <= 64, F.col("n")).otherwise(
        F.floor(F.pow(F.lit(2.0), F.floor(F.log2("n") * 8) / 8))
    )
    steps = counts.groupBy(step.cast("long").alias("from")).agg(F.count("*").alias("words"))
    total, least = 0, 1 << 62
    for r in sorted(steps.collect(), key=lambda r: -r["from"]):
        total += r["words"]
        if total > most:
            break
        least = r["from"]
    return least


def fit_classes(
    texts: DataFrame,
    counts: DataFrame,
    core_words: int = 4096,
    types: int = 1024,
    classes: int = 64,
    sweeps: int = 5,
    sent_words: int = 400_000,
    own_from: int = 1,
    share: float = 0.97,
    k: float = 0.1,
) -> tuple[ClassModel, DataFrame]:
    """Cluster the words of the corpus and estimate the class model, from all of ``text``.

    Returns the model, and a written table ``hash, n, class`` of all words but the ``core_words``.
    ``counts`` is the written table of ``word_counts``. Sizes that come to the driver are set by
    the parameters: ``sent_words`` counts and classes, ``core_words + types`` rows a sweep, and
    sums by class.
    """
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, distinct = int(sums["n"] or 0), int(sums["v"])
    least = _at_least(counts, sent_words)
    sent = counts.filter((F.col("n") >= least) | (F.col("hash") == END))
    rows = sent.select("hash", "n").toPandas()
    hashes = rows["hash"].to_numpy(np.int64).view(np.uint64)
    n = rows["n"].to_numpy(np.int64)
    if not (hashes == END).any():
        hashes, n = np.append(hashes, np.uint64(END)), np.append(n, 0)
    by_hash = np.argsort(hashes)
    hashes, n = hashes[by_hash], n[by_hash]
    # the end is unit 0 whatever its count
    ranked = np.lexsort((hashes, -n, hashes != END))[:core_words]
    core = np.sort(hashes[ranked])
    rank = np.empty(len(core), dtype=np.int64)
    rank[np.searchsorted(core, hashes[ranked])] = np.arange(len(core))
    units = Units(core, rank, types)

    around = stage(contexts(unit_pairs(texts, units)), "contexts")
    order = np.arange(units.number)
    found = order % classes
    for sweep in range(sweeps):
        counted = class_contexts(around, units.number, found, classes)
        if not sweep:  # first by frequency
            order = np.argsort(-counted[0].sum(axis=1), kind="stable")
            found = np.empty(units.number, dtype=np.int64)
            found[order] = np.arange(units.number) % classes
            counted = class_contexts(around, units.number, found, classes)
        found = exchange(counted, found, classes, order)
    kind = np.arange(units.number) >= len(core)
    counted = class_contexts(around, units.number, found + classes * kind, 2 * classes)
    into, out = counted[0, :, :-1], counted[1, :, :-1]
    twice = counted[1, :, -1]

    follow = np.zeros((classes, classes))
    np.add.at(follow, found, out[:, :classes] + out[:, classes:])
    np.add.at(follow, (found, found), twice)
    moves, prior = _moves(follow)
    # P(class | before) P(after | class) / mass of the class, by neighbour and class
    before = np.log(moves) - np.log(follow.sum(axis=0) + 1)
    gains = np.concatenate([before, before, np.log(moves.T), np.log(moves.T)])
    of_type = found[len(core):]
    table = stage(
        assign(word_contexts(texts, units, found, classes), of_type, gains, own_from), "words"
    )
    words = table.filter("code IS NULL").select("hash", "n", "class")

    # what follows what, now by the words' own classes
    sums = np.zeros((classes, 5 * classes))
    for r in table.filter("code IS NOT NULL").groupBy("class", "code").agg(F.sum("n")).collect():
        sums[r[0], r[1]] = r[2]
    after_core, after_rare = sums[:, 2 * classes:3 * classes], sums[:, 3 * classes:4 * classes]
    follow = np.zeros((classes, classes))
    np.add.at(follow, found[: len(core)], out[: len(core), :classes])
    np.add.at(follow, (found[: len(core)],) * 2, twice[: len(core)])
    follow += sums[:, :classes].T + after_core
    # of two rare words in a row the second is known by the class of its spelling: it counts for
    # the classes that words of such spelling have gone to
    went = sums[:, 4 * classes:].T
    follow += after_rare @ (went / np.maximum(went.sum(axis=1, keepdims=True), 1))
    moves, prior = _moves(follow)

    place = np.searchsorted(hashes, core)
    own = found[rank]
    mass = np.bincount(own, n[place], classes)
    held_words = np.bincount(own, n[place] > 0, classes)
    for r in words.groupBy("class").agg(F.count("*"), F.sum("n")).collect():
        held_words[r[0]] += r[1]
        mass[r[0]] += r[2]
    held = mass + k * (held_words + 1)
    # each class has one event for all words never seen, which the share of plain counts shares
    plain = tokens + k * (distinct + classes)
    bracket = share * moves / held[None, :] + (1 - share) / plain
    top_classes = np.zeros(len(hashes), dtype=np.int64)
    frequent = words.filter(F.col("n") >= least).select("hash", "class").toPandas()
    at = np.searchsorted(hashes, frequent["hash"].to_numpy(np.int64).view(np.uint64))
    top_classes[at] = frequent["class"].to_numpy()
    top_classes[place] = own
    model = ClassModel(
        of_type, int(found[units.end]), np.log10(bracket), hashes, n, top_classes, tokens,
        distinct, k,
    )
    return model, words


def _moves(follow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed probabilities of a class after another one, and of a class."""
    into = follow.sum(axis=0)
    prior = (into + 1) / (into + 1).sum()
    return (follow + 5 * prior) / (follow.sum(axis=1, keepdims=True) + 5), prior


_SCORED = (
    "row long, doc_id long, part double, known long, n_tokens long, base double, "
    "words array<long>, spelled array<int>, which array<int>, left array<int>, right array<int>"
)


def _scored(texts: DataFrame, model: ClassModel) -> DataFrame:
    """Per text what can be told without its rare words (those that are not sent along).

    ``words`` are its rare words, each once, ``spelled`` the classes of their spelling; ``which`` says
    for every place of a rare word which of them it is, ``left`` and ``right`` are the classes beside
    it, -1 for another rare word.
    """
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        end = model.end_class
        end_count = model.top_counts[np.searchsorted(model.top, np.uint64(END))]
        row = TaskContext.get().partitionId() << 36
        for whole in batches:
            for batch in slices(whole, "text"):
                n = batch.num_rows
                words = Spelled.of(batch.column("text"), len(model.of_type))
                found, sizes = words.at, words.sizes
                own, count = (c[found] for c in model.columns(words.hash))
                own, count = _with_ends(own, sizes, end), _with_ends(count, sizes, end_count)
                previous, sent = np.append(end, own[:-1]), count >= 0
                counted = np.where(sent, np.log10(np.maximum(count, 0) + model.k), 0.0)
                moved = np.where(sent & (previous >= 0), model.log_bracket[previous, own], 0.0)
                starts = np.cumsum(sizes + 1) - (sizes + 1)
                rare = np.flatnonzero(~sent)
                doc = np.repeat(np.arange(n), sizes + 1)[rare]
                word = _with_ends(found, sizes, -1)[rare]
                # words of a document in any order, each once
                pair, first, which = np.unique(
                    doc * max(len(words.hash), 1) + word, return_index=True, return_inverse=True
                )
                per = np.searchsorted(doc[first], np.arange(n + 1)).astype(np.int32)
                cuts = pa.array(per)
                places = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
                lists = [
                    (cuts, words.hash[word[first]].view(np.int64)),
                    (cuts, model.of_type[words.spelling[word[first]]].astype(np.int32)),
                    (places, (which - per[doc]).astype(np.int32)),
                    (places, previous[rare].astype(np.int32)),
                    (places, own[rare + 1].astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row + np.arange(n)), batch.column("doc_id"),
                        pa.array(np.add.reduceat(moved, starts)),
                        pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                        pa.array(sizes + 1), pa.array(np.add.reduceat(counted, starts)),
                        *(pa.ListArray.from_arrays(c, pa.array(v)) for c, v in lists),
                    ],
                    names=["row", "doc_id", "part", "known", "n_tokens", "base", "words",
                           "spelled", "which", "left", "right"],
                )
                row += n

    return texts.select("doc_id", "text").mapInArrow(run, _SCORED)


def _finished(scored: DataFrame, model: ClassModel) -> DataFrame:
    """Add what the rare words of a text bring; ``at, class, n`` are lists of those in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            per, found, places = (lengths(batch.column(c)) for c in ("spelled", "at", "which"))
            start = np.cumsum(per) - per
            own = batch.column("spelled").flatten().to_numpy().astype(np.int64)
            count = np.zeros(len(own), dtype=np.int64)
            at = np.repeat(start, found) + batch.column("at").flatten().to_numpy()
            own[at] = batch.column("class").flatten().to_numpy()
            count[at] = batch.column("n").flatten().to_numpy()
            which = np.repeat(start, places) + batch.column("which").flatten().to_numpy()
            doc = np.repeat(np.arange(rows), places)
            own, count = own[which], count[which]
            left, right = (batch.column(c).flatten().to_numpy() for c in ("left", "right"))
            # beside a rare word on the left lies the place before in the list
            left = np.where(left < 0, np.append(0, own)[:-1], left)
            moved = model.log_bracket[left, own]
            moved += np.where(right < 0, 0.0, model.log_bracket[own, right])
            values = [
                batch.column("doc_id"), batch.column("n_tokens"),
                batch.column("known").to_numpy() + np.bincount(doc, count > 0, rows).astype(np.int64),
                batch.column("base").to_numpy() + np.bincount(doc, np.log10(count + model.k), rows),
                batch.column("part").to_numpy() + np.bincount(doc, moved, rows),
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) if isinstance(v, np.ndarray) else v for v in values],
                names=["doc_id", "n_tokens", "known", "counted", "part"],
            )

    return scored.mapInArrow(
        run, "doc_id long, n_tokens long, known long, counted double, part double"
    )


def score_texts(docs: DataFrame, learn: Column, text: str = "text", doc_id: str = "doc_id",
                **sizes) -> DataFrame:
    """``doc_id, n_tokens, n_known, train_tokens, base_score, score`` of every document.

    The model learns from all documents for which ``learn`` holds: word counts, unit bigrams and
    classes cover their whole texts. ``score`` is the log10 probability of the whole text, its end
    included; ``base_score`` that of word frequencies alone. ``n_known`` counts tokens with a
    count. A null or empty text is its end alone. Repeated rows are learned and scored each; a
    null id stays null; without documents to learn from every word is unknown; an empty table
    gives no rows; other columns are not read.

    Texts are not shuffled. Counts are summed in every task first, so a frequent word is one row
    a task. Words whose counts and classes are not sent to the tasks (all but ``sent_words``) are
    joined with the table of words, one row a document and word.
    """
    ready(docs.sparkSession)
    types = sizes.setdefault("types", 1024)
    body = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learned"),
    )
    learned = body.filter("learned")
    counts = stage(word_counts(learned, types), "counts")
    model, words = fit_classes(learned, counts, **sizes)
    scored = stage(_scored(body, model), "scored")
    rare = scored.select("row", F.posexplode("words").alias("at", "hash"))
    found = F.collect_list(F.struct("at", "class", "n")).alias("l")
    rest = rare.join(words, "hash").groupBy("row").agg(found).select(
        "row", "l.at", "l.class", "l.n"
    )
    done = _finished(scored.drop("words").join(rest, "row", "left").drop("row"), model)
    return done.select(
        "doc_id", "n_tokens", F.col("known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("counted") - F.col("n_tokens") * F.lit(float(np.log10(model.base_mass)))).alias(
            "base_score"
        ),
        (F.col("counted") + F.col("part")).alias("score"),
    )
