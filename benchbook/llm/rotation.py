"""Fill-in-middle: cut texts at tokens, mark the parts, exchange them in place, restore exactly.

A text stays in one bytearray from its first to its last form. Sentinels are inserted at the cuts,
so that it reads prefix, middle, suffix; one rotation then exchanges neighbouring parts, made of
three reversals, and its inverse brings them back.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchbook.llm.common import ready, slices, text_of, unused

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes that a reversal holds beside the text.
BLOCK = 1 << 16
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def token_ends(raw: bytes | bytearray) -> np.ndarray:
    """Where the tokens of a text end, in bytes.

    A token is a word with the blanks before it, or the blanks after the last word. Blanks are
    ASCII, so bytes and code points cut alike.
    """
    if not raw:
        return np.zeros(0, dtype=np.int64)
    blank = _BLANK[np.frombuffer(raw, dtype=np.uint8)]
    return np.append(np.flatnonzero(~blank[:-1] & blank[1:]) + 1, len(raw))


def code_points(raw: bytes | bytearray, start: int, end: int) -> int:
    part = np.frombuffer(raw, dtype=np.uint8)[start:end]
    return int(np.count_nonzero((part & 0xC0) != 0x80))


def reverse(view: np.ndarray, start: int, end: int) -> None:
    """Turn ``view[start:end]`` round where it lies, a block from either end at a time."""
    while end - start > 1:
        size = min(BLOCK, (end - start) // 2)
        head = view[start : start + size].copy()
        view[start : start + size] = view[end - size : end][::-1]
        view[end - size : end] = head[::-1]
        start, end = start + size, end - size


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """Exchange ``[start, cut)`` and ``[cut, end)``; undone by the cut ``start + end - cut``."""
    view = np.frombuffer(buffer, dtype=np.uint8)
    reverse(view, start, cut)
    reverse(view, cut, end)
    reverse(view, start, end)


def draws(seed: int, key: object) -> list[int]:
    """Four numbers from 0 to 2**32 - 1 that seed and id of a document always give; a null id
    counts as the empty text."""
    found = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(found[8 * i : 8 * i + 8], 16) for i in range(4)]


def rearrange(
    buffer: bytearray, drawn: list[int], rate: int = 50, spm: int = 80
) -> tuple[int, str, int | None, int | None]:
    """Bring one text into its form, in place: tokens, form, code points of prefix and middle.

    ``rate`` percent of the texts are rearranged, ``spm`` percent of those with the suffix first.
    An empty text, and one that holds a sentinel, stays ``plain``.
    """
    ends = token_ends(buffer)
    n = len(ends)
    marked = any(s in buffer for s in (PREFIX, SUFFIX, MIDDLE))
    if not buffer or marked or drawn[2] % 100 >= rate:
        return n, "plain", None, None
    a, b = (int(ends[k - 1]) if k else 0 for k in sorted(d % (n + 1) for d in drawn[:2]))
    sizes = code_points(buffer, 0, a), code_points(buffer, a, b)
    buffer[b:b] = SUFFIX
    buffer[a:a] = MIDDLE
    buffer[0:0] = PREFIX
    middle, suffix = a + 3, b + 6
    if drawn[3] % 100 < spm:
        rotate(buffer, 0, suffix, len(buffer))
        return n, "spm", *sizes
    rotate(buffer, middle, suffix, len(buffer))
    return n, "psm", *sizes


def restore(buffer: bytearray, form: str) -> None:
    """The text that was brought into ``form``, in place."""
    if form == "plain":
        return
    end = len(buffer)
    if form == "spm":
        rotate(buffer, 0, buffer.find(PREFIX), end)
    else:
        first, second = buffer.find(SUFFIX), buffer.find(MIDDLE)
        rotate(buffer, first, second, end)
    for sentinel in (SUFFIX, MIDDLE, PREFIX):
        at = buffer.find(sentinel)
        del buffer[at : at + len(sentinel)]


def _through(
    df: DataFrame, read: list[str], added: T.StructType, work, types: list[pa.DataType]
) -> DataFrame:
    """Add columns that ``work`` makes of the read ones, the first of them the text, row by row.

    All other columns pass through Python unread; a column named like an added one is replaced.
    """
    ready(df.sparkSession)
    kept = [f for f in df.schema.fields if f.name not in added.names]
    names = [f.name for f in kept]
    missing = [c for c in read if c not in names]
    text = read[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                rows = [work(*row) for row in zip(*[batch.column(c).to_pylist() for c in read])]
                made = [
                    pa.array([r[i] for r in rows], type=kind) for i, kind in enumerate(types)
                ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in names] + made, names=names + added.names
                )

    columns = [F.col(f"`{c}`") for c in names + missing]
    return df.select(*columns).mapInArrow(run, T.StructType([*kept, *added]))


def fill_in_middle(
    df: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    seed: int = 42,
    rate: int = 50,
    spm: int = 80,
    output: str = "output",
) -> DataFrame:
    """Add ``n`` (tokens), ``form`` (plain, psm, spm), ``prefix_chars``, ``middle_chars`` and the
    rearranged text ``output`` to every document.

    Per row, no shuffle; a task holds one slice of texts, and one text beside its bytearray. What
    a document becomes depends on seed, id and text alone, so a task that is run again gives the
    same. A null text counts as empty and stays plain, a null id as the empty text; repeated rows
    give equal rows. Columns named like a result are replaced.
    """
    added = T.StructType(
        [
            T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
            T.StructField("prefix_chars", T.LongType()),
            T.StructField("middle_chars", T.LongType()), T.StructField(output, T.StringType()),
        ]
    )

    def work(value: str | None, at: object) -> tuple:
        buffer = bytearray((value or "").encode())
        found = rearrange(buffer, draws(seed, at), rate, spm)
        return *found, bytes(buffer)

    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return _through(df, [text, key], added, work, types)


def restored(
    df: DataFrame, output: str = "output", form: str = "form", into: str = "restored"
) -> DataFrame:
    """Add the exact text that ``output`` was made of, from output and form alone. Null outputs
    give empty texts, null forms are taken for plain."""
    added = T.StructType([T.StructField(into, T.StringType())])

    def work(value: str | None, shape: str | None) -> tuple:
        buffer = bytearray((value or "").encode())
        restore(buffer, shape or "plain")
        return (bytes(buffer),)

    return _through(df, [output, form], added, work, [pa.string()])


def rearranged_digests(df: DataFrame) -> DataFrame:
    """Counts and digests of every rearranged and restored text, as the registered query gives."""
    found = fill_in_middle(df.select("doc_id", text_of("text").alias("text"))).drop("text")
    return restored(found).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )


CHECK_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
k AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
    list_transform([1, 9, 17, 25], lambda i: ('0x' || h[i : i + 7])::BIGINT) AS r FROM d),
c AS (
  SELECT *, len(u) AS n, least(r[1] % (len(u) + 1), r[2] % (len(u) + 1)) AS a,
    greatest(r[1] % (len(u) + 1), r[2] % (len(u) + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
      OR r[3] % 100 >= 50 THEN 'plain' WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM k),
p AS (
  SELECT doc_id, t, n, form, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m,
    array_to_string(u[b + 1 : n], '') AS s FROM c),
o AS (
  SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS o FROM p),
back AS (
  SELECT *, CASE form WHEN 'plain' THEN o
    WHEN 'psm' THEN split_part(split_part(o, '<P>', 2), '<S>', 1) || split_part(o, '<M>', 2)
      || split_part(split_part(o, '<S>', 2), '<M>', 1)
    ELSE split_part(split_part(o, '<P>', 2), '<M>', 1) || split_part(o, '<M>', 2)
      || split_part(split_part(o, '<S>', 2), '<P>', 1) END AS again FROM o)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(o) AS output_sha256, sha256(again) AS restored_sha256 FROM back"""
