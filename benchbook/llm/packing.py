"""Hierarchical packing: documents to context tiers, tiers to windows, gaps filled from below."""

from __future__ import annotations

import array
import bisect
import itertools
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.llm.common import ready, slices, text_of

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, sequence_tokens long, tier int, step_group long"
)
_TYPES = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
        ("offset", pa.int64()), ("sequence_tokens", pa.int64()), ("tier", pa.int32()),
        ("step_group", pa.int64()),
    ]
)


#: Words that are one run of letters, one run of signs, or both in this order: so many
#: pre-tokens, each of which ends with an id that ends a word.
_PLAIN = re.compile("([a-z\u00e0-\u00f6\u00f8-\u00ff]*)([!-&(-/:;=-@\\[-`{-~]*)")


class WordIds:
    """Ids of white-space separated words, each lower-cased word encoded once per worker.

    The tokenizer never joins anything over ASCII white space and lower-cases letter by letter, so
    the ids of a text are those of its words in order. Memory is bounded: with ``limit`` words
    known it starts anew.
    """

    def __init__(self, path: str, limit: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.ids, self.stops = array.array("I"), array.array("q", [0])

    def learn(self, words: list[bytes]) -> None:
        plain, parts = [], []
        for word in words:
            text = word.decode()
            if m := _PLAIN.fullmatch(text):
                plain.append(word)
                parts.append(bool(m[1]) + bool(m[2]))
            else:
                self.index[word] = len(self.index)
                self.ids.extend(self.tokenizer.encode(text, add_special_tokens=False).ids)
                self.stops.append(len(self.ids))
        for at in range(0, len(plain), 1000):  # many in one call, taken apart at word ends
            some = plain[at : at + 1000]
            joined = b" ".join(some).decode()
            ids = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids
            ends = np.flatnonzero(self.ends_word[ids]) + 1
            stops = ends[np.cumsum(parts[at : at + 1000]) - 1] + len(self.ids)
            self.index.update(zip(some, range(len(self.index), len(self.index) + len(some))))
            self.ids.extend(ids)
            self.stops.extend(stops.tolist())

    def of(self, texts: list[str], end: int) -> list[np.ndarray]:
        """Ids of every text, each with ``end`` after it."""
        if any("<|" in t for t in texts):  # may name special tokens, which keep their case
            return [
                np.array([*self.tokenizer.encode(t, add_special_tokens=False).ids, end], "<u4")
                if "<|" in t else self.of([t], end)[0]
                for t in texts
            ]
        split = [t.encode().lower().split() for t in texts]
        words = list(itertools.chain.from_iterable(split))
        seen = set(words)
        if new := seen.difference(self.index):
            if len(self.index) + len(new) > self.limit:
                self.clear()
                new = seen
            self.learn(list(new))
        known = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        stops = np.array(self.stops, dtype=np.int64)
        sizes = (stops[1:] - stops[:-1])[known]
        till = np.cumsum(sizes)
        flat = np.array(self.ids, dtype="<u4")
        ids = flat[np.arange(till[-1] if len(till) else 0) + np.repeat(stops[known] - till + sizes, sizes)]
        cuts = np.concatenate([[0], till])[np.cumsum([0, *map(len, split)])]
        return [np.append(ids[a:b], np.uint32(end)) for a, b in zip(cuts[:-1], cuts[1:])]


_WORDS: dict[str, WordIds] = {}


def token_ids(texts: list[str], path: str, end: int) -> list[np.ndarray]:
    """Ids of every text with ``end`` after each; words stay known while the worker lives."""
    if path not in _WORDS:
        _WORDS[path] = WordIds(path)
    return _WORDS[path].of(texts, end)


class Packer:
    """Packs documents of one task into windows, in batches of bounded size.

    1. What a document has in whole windows of the longest tier is cut off as such.
    2. The rest is routed to the shortest tier that holds it.
    3. Longest tier first, each document opens a window of its tier; the gap is filled with the
       longest waiting documents that fit, from any shorter tier or its own, and where none fits,
       with a cut from the longest one waiting.
    4. Windows of one batch are dealt to step groups in turn, long ones first, in a snake, so that
       groups differ by less than one window.

    At the end the rest is laid into windows of falling powers of two, so nothing is padded.
    """

    def __init__(self, tiers: tuple[int, ...], steps: int, base: int):
        self.tiers, self.steps = tuple(sorted(tiers)), steps
        self.next, self.group = base, base
        self.waiting: list[tuple[int, int, int]] = []  # tokens left, order, document
        self.docs: dict[int, tuple[int | None, np.ndarray, int]] = {}
        self.order, self.held = 0, 0
        self.rows: list[tuple] = []
        self.windows: list[tuple[int, int, int]] = []  # size, first row, end row

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        longest = self.tiers[-1]
        n = len(ids)
        at = 0
        while n - at >= longest:
            self._emit([(doc_id, ids, at, longest)], longest)
            at += longest
        if at < n:
            self.docs[self.order] = (doc_id, ids, at)
            self.waiting.append((n - at, self.order, self.order))
            self.order += 1
            self.held += n - at

    def _emit(self, pieces: Iterable[tuple], tier: int) -> None:
        first, offset = len(self.rows), 0
        pieces = list(pieces)
        total = sum(p[3] for p in pieces)
        for doc_id, ids, at, length in pieces:
            crc = zlib.crc32(ids[at : at + length].tobytes())
            self.rows.append((doc_id, at, length, crc, len(ids), self.next, offset, total, tier))
            offset += length
        self.windows.append((total, first, len(self.rows)))
        self.next += 1

    def _take(self, index: int, room: int) -> tuple:
        left, order, doc = self.waiting.pop(index)
        doc_id, ids, at = self.docs[doc]
        used = min(left, room)
        if used < left:
            self.docs[doc] = (doc_id, ids, at + used)
            bisect.insort(self.waiting, (left - used, order, doc))
        else:
            del self.docs[doc]
        self.held -= used
        return doc_id, ids, at, used

    def pack(self, last: bool) -> list[tuple]:
        """Rows of all windows that are full; with ``last`` of everything."""
        self.waiting.sort()
        while self.waiting:
            longest = self.waiting[-1][0]
            tier = next(t for t in self.tiers if t >= longest)
            if self.held < tier:
                if not last:
                    break
                tier = 1 << (self.held.bit_length() - 1)
            room, pieces = tier, []
            while room:
                # the longest that fits; else the longest of all is cut
                at = bisect.bisect_right(self.waiting, (room, self.order, self.order)) - 1
                piece = self._take(at if at >= 0 else len(self.waiting) - 1, room)
                pieces.append(piece)
                room -= piece[3]
            self._emit(pieces, tier)
        rows, self.rows = self.rows, []
        windows, self.windows = self.windows, []
        groups = max(1, -(-sum(w[0] for w in windows) // self.steps))
        turn = [*range(groups), *reversed(range(groups))]
        out = []
        ranked = sorted(windows, key=lambda w: (-w[0], w[1]))
        for i, (_, first, stop) in enumerate(ranked):
            group = self.group + turn[i % len(turn)]
            out += [(*row, group) for row in rows[first:stop]]
        self.group += groups
        return out


def pack_documents(
    df: DataFrame,
    tokenizer: str,
    end: int = 2,
    tiers: tuple[int, ...] = (512, 1024, 2048, 4096),
    step_tokens: int = 262_144,
    buffer_tokens: int = 1_000_000,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of all documents in sequences of at most the longest tier; see ``Packer``.

    Every task packs its own documents as it reads them, holding ``buffer_tokens`` at most and
    one document, so texts and ids are never shuffled. Sequence and step numbers start at the
    task's number times 2**40. A null or empty text is the end id alone; a null id stays null;
    repeated rows are documents of their own; an empty table gives no rows. ``tokenizer`` is the
    path of a tokenizer file on every executor.
    """
    ready(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        packer = Packer(tiers, step_tokens, (task.partitionId() if task else 0) << 40)

        def out(last: bool) -> pa.RecordBatch:
            rows = packer.pack(last)
            columns = list(zip(*rows)) or [[]] * len(_TYPES)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, _TYPES)], schema=_TYPES
            )

        for whole in batches:
            for batch in slices(whole, "text"):
                found = token_ids(batch.column("text").to_pylist(), tokenizer, end)
                for key, ids in zip(batch.column("doc_id").to_pylist(), found):
                    packer.add(key, ids)
                if packer.held >= buffer_tokens or len(packer.rows) > 100_000:
                    yield out(False)
        yield out(True)

    ids = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return ids.mapInArrow(run, SCHEMA)
