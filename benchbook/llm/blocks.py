"""Comparing all members of a group with each other without one task holding the group.

A group is cut into chunks by a hash; a task gets two chunks. What leaves a task are a count and
one edge a member, never the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Links of a block: ``i, j`` positions of linked members, for members and their chunk side.
Links = Callable[[pa.Table, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def local_components(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest position that each of ``n`` positions is linked to."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def chunk_pairs(members: DataFrame, chunk_rows: int, weight: str, chunk_weight: int) -> DataFrame:
    """Each member of ``group, node, ...`` once for every pair of chunks that its own is in.

    Adds ``c1, c2, side``. Groups of up to ``chunk_rows`` members and ``chunk_weight`` in all (of
    the column ``weight``) are one chunk and are not repeated.
    """
    sizes = members.groupBy("group").agg(
        F.greatest(
            F.ceil(F.count("*") / chunk_rows), F.ceil(F.sum(weight) / chunk_weight), F.lit(1)
        ).cast("int").alias("_n")
    )
    chunk = F.pmod(F.xxhash64("node"), F.col("_n")).cast("int")
    cut = members.join(sizes, "group").withColumn("_c", chunk)
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("_d")
    return cut.select("*", other).select(
        *members.columns, F.least("_c", "_d").alias("c1"), F.greatest("_c", "_d").alias("c2"),
        F.col("_c").alias("chunk"),
    )


def groups_of(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows that agree in ``names``, from batches sorted by them."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*[batch.column(n).to_pylist() for n in names]))
        table = pa.Table.from_batches([batch])
        start = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[start]:
                continue
            if held and keys[start] != last:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(table.slice(start, i - start))
            last, start = keys[start], i
    if held:
        yield pa.concat_tables(held).combine_chunks()


def count_links(paired: DataFrame, links: Links, columns: list[str]) -> DataFrame:
    """``node, near, low`` for every member and block of ``chunk_pairs``.

    ``near`` is the sum of ``copies`` of the members linked to it in this block, ``low`` a member
    of the same block that it is linked to over others, itself if there is none.
    """
    keys = ["group", "c1", "c2"]
    own = paired.select(*keys, "chunk", "node", "copies", *columns)
    placed = own.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, keys):
            n = group.num_rows
            chunk = group.column("chunk").to_numpy()
            c1, c2 = group.column("c1")[0].as_py(), group.column("c2")[0].as_py()
            left = np.flatnonzero(chunk == c1)
            right = np.flatnonzero(chunk == c2)
            if not len(left) or not len(right):
                continue
            i, j = links(group, left, right)
            if c1 == c2:
                i, j = i[i < j], j[i < j]
            copies = group.column("copies").to_numpy().astype(np.float64)
            near = np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
            low = local_components(n, i, j)
            nodes = group.column("node").combine_chunks()
            hit = np.flatnonzero(near > 0)
            if len(hit):
                yield pa.RecordBatch.from_arrays(
                    [
                        nodes.take(pa.array(hit)).cast(pa.binary()),
                        pa.array(near[hit].round().astype(np.int64)),
                        nodes.take(pa.array(low[hit])).cast(pa.binary()),
                    ],
                    names=["node", "near", "low"],
                )

    return placed.mapInArrow(run, "node binary, near long, low binary")
