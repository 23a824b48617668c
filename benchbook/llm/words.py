"""Words of whole texts as numbers, each word worked out once per worker."""

from __future__ import annotations

import itertools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Words that are remembered at once; with more, a worker starts anew.
LIMIT = 800_000


class Hashes:
    """64-bit hashes of white-space separated, lower-cased words of texts."""

    def __init__(self, limit: int = LIMIT):
        self.limit, self.known = limit, {}

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of all texts in order, and the number of words of each."""
        split = [t.lower().split() for t in texts]
        words = list(itertools.chain.from_iterable(split))
        new = set(words).difference(self.known)
        if new:
            if len(self.known) + len(new) > self.limit:
                self.known.clear()
                new = set(words)
            self.known.update({w: xxhash.xxh64_intdigest(w.encode()) for w in new})
        hashes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        return hashes, np.fromiter(map(len, split), np.int64, len(split))


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values, so that every bit depends on every bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingles(hashes: np.ndarray, sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words of each text, and their number a text.

    A text of fewer words, but at least one, has one run: all its words.
    """
    counts = np.where(sizes >= width, sizes - width + 1, np.minimum(sizes, 1))
    ends = np.cumsum(sizes)
    starts = np.repeat(ends - sizes, counts)
    first = np.cumsum(counts) - counts
    at = starts + np.arange(len(starts)) - np.repeat(first, counts)
    stop = np.repeat(ends, counts)
    out = np.zeros(len(at), dtype=np.uint64)
    rng = np.random.default_rng(5)
    for k in range(width):
        factor = np.uint64(rng.integers(1, 1 << 62) * 2 + 1)
        inside = at + k < stop
        value = hashes[np.minimum(at + k, max(len(hashes) - 1, 0))] if len(hashes) else out
        out = out + np.where(inside, value * factor, np.uint64(0))
    return mixed(out), counts


@dataclass(frozen=True)
class Spelled:
    """The words of some texts: runs without ASCII white space, A-Z lower-cased, nothing else
    changed. Arrow cuts the texts and numbers distinct words, so Python sees each of those once."""

    at: np.ndarray  # number of each word, in the order of the texts
    sizes: np.ndarray  # words of each text
    hash: np.ndarray  # 64-bit hash, by number
    spelling: np.ndarray  # spelling type, by number

    @classmethod
    def of(cls, texts: pa.Array, types: int) -> Spelled:
        split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        words, sizes = split.flatten(), pc.list_value_length(split).to_numpy()
        # white space at the ends of a text leaves empty words there
        real = pc.greater(pc.binary_length(words), 0)
        if not pc.all(real, min_count=0).as_py():
            kept = real.to_numpy(zero_copy_only=False)
            text = np.repeat(np.arange(len(sizes)), sizes)
            sizes = np.bincount(text[kept], minlength=len(sizes))
            words = words.filter(real)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.cast(pa.binary()).to_pylist()
        n = len(distinct)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, distinct), np.uint64, n)
        # the last three bytes say most about the form of a word and its language
        spelling = np.fromiter((zlib.crc32(w[-3:]) for w in distinct), np.int64, n) % types
        at = coded.indices.to_numpy().astype(np.int64)
        return cls(at, sizes.astype(np.int64), hashes, spelling)
