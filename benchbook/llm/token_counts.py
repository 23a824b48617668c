"""Token counts of a sentencepiece BPE model, by pre-tokens that no merge can cross.

A merge joins two neighbouring symbols into a piece of the vocabulary, so it can only cross a place
between two characters that stand side by side in some piece. Texts are cut where none does: the
number of tokens is then the sum over the pre-tokens, whatever the order of merges.

Lengths come from two tiers, both held by the worker. The first is a broadcast table of the most
frequent pre-tokens of the corpus; the second holds what the worker has met besides, each encoded
once by the library. No pre-token is shuffled: tasks count in sketches of a fixed size, and
sketches, one row a task, are merged in a fixed number of places.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchbook.llm.common import ready, slices, text_of

#: The sign that the model writes for a space.
SPACE = "▁"
#: Pre-tokens that are broadcast, and that a sketch keeps; a sketch grows to GROWTH times as many.
FREQUENT, GROWTH = 32_768, 8
#: Pre-tokens that a worker holds besides, and the characters of the longest one that it holds.
CACHED, LONGEST = 600_000, 64
#: Places in which sketches are merged before the last of them come to the driver.
MERGERS = 16
_LETTER = r"[^\W\d_]"


def pieces_of(model) -> list[str]:
    """All pieces that a merge can make or leave: neither special nor a byte."""
    return [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]


def safe_pattern(pieces: list[str]) -> re.Pattern:
    """Pre-tokens as finely as the vocabulary allows, in texts with spaces before words.

    Runs of letters and runs of other signs, each with the spaces before it, if no piece goes from
    a sign to a letter or from anything to a space; single pairs from a letter to a sign keep the
    run of signs with the letters. Else words with the spaces before them, else whole texts.
    """
    pairs = {pair for piece in pieces for pair in zip(piece, piece[1:])}
    letter = re.compile(_LETTER)
    if any(b == SPACE != a for a, b in pairs):
        return re.compile(r"[\s\S]+")
    rest = [(a, b) for a, b in pairs if a != SPACE]
    if any(letter.match(b) and not letter.match(a) for a, b in rest):
        return re.compile(" *[^ ]+| +")
    joined = sorted(pair for pair in rest if letter.match(pair[0]) and not letter.match(pair[1]))
    held = "|".join(f"(?<={re.escape(a)})(?={re.escape(b)})" for a, b in joined)
    signs = r"(?:(?![^\W\d_])[^ ])+"
    word = rf"{_LETTER}+(?:(?:{held}){signs})?" if joined else rf"{_LETTER}+"
    return re.compile(rf" *{word}| *{signs}| +")


@dataclass
class Lengths:
    """Numbers of tokens of pre-tokens of one model file."""

    path: str

    def __post_init__(self) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=self.path)
        pieces = pieces_of(self.model)
        inside = set("".join(pieces))
        # a character of no piece is spelled in bytes and merges with nothing: a guard that keeps
        # the space that the model puts before a text away from the pre-token
        self.guard = next(c for c in "\n\t\x00" if c not in inside)
        if not any(self.model.is_byte(i) for i in range(self.model.get_piece_size())):
            raise ValueError("characters outside the vocabulary must be spelled in bytes")
        self.find = safe_pattern(pieces).findall
        self.guarded = len(self.model.encode(self.guard))

    def cut(self, text: str) -> list[str]:
        """Pre-tokens of a text, with the space that the model puts before it."""
        return self.find(" " + text.replace(SPACE, " ")) if text else []

    def of(self, words: list[str]) -> list[int]:
        """Tokens of pre-tokens, as the library encodes them behind the guard."""
        out: list[int] = []
        for at in range(0, len(words), 1000):
            some = [self.guard + w for w in words[at : at + 1000]]
            out += [len(ids) - self.guarded for ids in self.model.encode(some, num_threads=1)]
        return out


class TwoTiers:
    """Counts tokens of texts with a fixed table of lengths and a bounded cache beside it."""

    def __init__(self, lengths: Lengths, frequent: dict[str, int], limit: int = CACHED):
        self.lengths, self.frequent, self.limit = lengths, frequent, limit
        self.known = dict(frequent)

    def count(self, texts: list[str]) -> np.ndarray:
        cut = [self.lengths.cut(t) for t in texts]
        words = list(itertools.chain.from_iterable(cut))
        missed = list(set(words).difference(self.known))
        self.known.update(zip(missed, self.lengths.of(missed)))
        flat = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        for word in missed:  # long ones are seldom met again and would only fill the memory
            if len(word) > LONGEST:
                del self.known[word]
        if len(self.known) - len(self.frequent) > self.limit:
            self.known = dict(self.frequent)
        total = np.concatenate([[0], np.cumsum(flat)])
        ends = np.cumsum([0, *map(len, cut)])
        return total[ends[1:]] - total[ends[:-1]]


class Sketch:
    """Counts of the most frequent items in bounded memory (Misra and Gries).

    An item that makes up more than one in ``size`` of all is never lost, and sketches add up to
    a sketch of all they saw.
    """

    def __init__(self, size: int):
        self.size, self.counts = size, Counter()

    def add(self, items: list[str]) -> None:
        self.counts.update(items)
        if len(self.counts) > GROWTH * self.size:
            self.shrink()

    def merge(self, items: list[str], counts: list[int]) -> None:
        for item, n in zip(items, counts):
            self.counts[item] += n
        if len(self.counts) > GROWTH * self.size:
            self.shrink()

    def shrink(self) -> None:
        if len(self.counts) > self.size:
            sizes = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            less = int(np.partition(sizes, len(sizes) - self.size - 1)[len(sizes) - self.size - 1])
            self.counts = Counter({w: n - less for w, n in self.counts.items() if n > less})

    def row(self, place: int) -> pa.RecordBatch:
        self.shrink()
        return pa.RecordBatch.from_arrays(
            [
                pa.array([place], type=pa.int64()),
                pa.array([list(self.counts)], type=pa.list_(pa.string())),
                pa.array([list(self.counts.values())], type=pa.list_(pa.int64())),
            ],
            names=["place", "items", "counts"],
        )


_SKETCHES = "place long, items array<string>, counts array<long>"
_LENGTHS: dict[str, Lengths] = {}
_TIERS: dict[tuple, TwoTiers] = {}


def lengths_of(path: str) -> Lengths:
    if path not in _LENGTHS:
        _LENGTHS[path] = Lengths(path)
    return _LENGTHS[path]


def frequent_pre_tokens(
    docs: DataFrame, path: str, text: str = "text", size: int = FREQUENT
) -> list[str]:
    """The ``size`` most frequent pre-tokens of all texts, as far as sketches of that size tell.

    Every task sends one row, at most ``size`` short strings with counts; ``MERGERS`` tasks merge
    them one after the other, so the driver gets as many rows whatever the size of the corpus.
    Pre-tokens longer than ``LONGEST`` characters are left to the workers.
    """
    ready(docs.sparkSession)
    rows = docs.select(text_of(f"`{text}`").alias("text"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch, cut = Sketch(size), lengths_of(path).cut
        for whole in batches:
            for batch in slices(whole, "text"):
                words = itertools.chain.from_iterable(map(cut, batch.column("text").to_pylist()))
                sketch.add([w for w in words if len(w) <= LONGEST])
        yield sketch.row(TaskContext.get().partitionId() % MERGERS)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketch(size)
        for batch in batches:
            for items, counts in zip(batch.column("items"), batch.column("counts")):
                sketch.merge(items.as_py(), counts.as_py())
        yield sketch.row(0)

    sketches = rows.mapInArrow(counted, _SKETCHES).repartition(MERGERS, "place")
    last = Sketch(size)
    for row in sketches.mapInArrow(merged, _SKETCHES).toLocalIterator():
        last.merge(row["items"], row["counts"])
    last.shrink()
    return [w for w, _ in sorted(last.counts.items(), key=lambda x: (-x[1], x[0]))]


def count_tokens(
    df: DataFrame,
    path: str,
    text: str = "text",
    n_tokens: str = "n_tokens",
    frequent: list[str] | None = None,
    limit: int = CACHED,
) -> DataFrame:
    """Add the number of tokens of every whole text, as the library's encode gives them.

    ``frequent`` (default: found in ``df`` itself, in a pass of its own) decides how fast texts
    are counted, never the counts. Per row, no shuffle; other columns pass through unread, a column
    named ``n_tokens`` is replaced. Null and empty texts have no tokens. A worker holds the table,
    at most ``limit`` further lengths, and one slice of texts (or one longer text) with its words.
    """
    spark = ready(df.sparkSession).sparkContext
    if frequent is None:
        frequent = frequent_pre_tokens(df, path, text)
    packed = pa.table({"w": frequent, "n": pa.array(lengths_of(path).of(frequent), type=pa.uint16())})
    table, made = spark.broadcast(packed), uuid.uuid4().hex
    kept = [f for f in df.schema.fields if f.name != n_tokens]
    names = [f.name for f in kept]
    read = names if text in names else [*names, text]
    schema = T.StructType([*kept, T.StructField(n_tokens, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = (path, made, limit)
        if at not in _TIERS:  # one table a worker: tasks of one query follow each other in it
            _TIERS.clear()
            words = dict(zip(table.value["w"].to_pylist(), table.value["n"].to_pylist()))
            _TIERS[at] = TwoTiers(lengths_of(path), words, limit)
        for whole in batches:
            for batch in slices(whole, text):
                texts = [t or "" for t in batch.column(text).to_pylist()]
                found = pa.array(_TIERS[at].count(texts), type=pa.int64())
                columns = [batch.column(c) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, found], names=[*names, n_tokens])

    return df.select(*[F.col(f"`{c}`") for c in read]).mapInArrow(run, schema)


def token_report(docs: DataFrame, path: str, limit: int = 4096) -> DataFrame:
    """Bytes, tokens and whether there are more than ``limit``, as the registered query gives."""
    rows = docs.select(
        "doc_id", text_of("text").alias("text"), F.octet_length(text_of("text")).cast("long").alias("n_bytes")
    )
    counted = count_tokens(rows, path).drop("text")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
