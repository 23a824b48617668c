"""Near-duplicate vectors: sorted passes over random projections, verified in windows."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.llm.blocks import chunk_pairs, count_links, groups_of, local_components
from benchbook.llm.common import components, meet, ready, stage

BITS = 64

#: Rows of the sample that a cut of a pass must still divide.
LEAF = 16


def passes_needed(vectors: float, window: int, threshold: float, recall: float) -> int:
    """Passes that bring a pair at ``threshold`` into one window with probability ``recall``.

    Two vectors at angle a agree in a sign with probability 1 - a/pi. They share a window of
    ``window`` rows if they agree in about log2(vectors / window) leading signs.
    """
    agree = 1 - math.acos(threshold) / math.pi
    depth = max(0.0, math.log2(max(vectors, 1) / window))
    once = agree**depth
    return 1 if once >= recall else math.ceil(math.log(1 - recall) / math.log(1 - once))


def planes(number: int, dimension: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, number, dimension]).standard_normal((dimension, BITS))


def unit(raw: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    """Rows of doubles of length 1 from packed vectors of one dimension."""
    packed = b"".join(raw.to_pylist())
    x = np.frombuffer(packed, dtype="<f8").reshape(-1, dimension)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow of squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@dataclass(frozen=True)
class Hashes:
    """The concatenated hashes of one pass: on which side of a random plane a vector lies.

    The first planes go through the median of the sampled vectors that share all hashes before,
    so a prefix of hashes holds about as many rows as any other of its length, however vectors
    crowd. The further planes go through the mean of the sampled vectors of their prefix.
    """

    planes: np.ndarray
    cuts: list[np.ndarray]  # by depth, one for each prefix
    centres: np.ndarray  # of each prefix, on the planes after the last cut
    shares: list[np.ndarray]  # by depth, the part of the sample that has each prefix

    def bits(self, x: np.ndarray) -> np.ndarray:
        on = x @ self.planes
        out = np.empty(on.shape, dtype=bool)
        at = np.zeros(len(x), dtype=np.int64)
        for depth, cut in enumerate(self.cuts):
            out[:, depth] = on[:, depth] >= cut[at]
            at = 2 * at + out[:, depth]
        deep = len(self.cuts)
        out[:, deep:] = on[:, deep:] >= self.centres[at]
        return out

    def share(self, bits: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Part of all rows that agree with each row in its first ``length`` hashes."""
        deep = len(self.cuts)
        out = np.zeros(len(bits))
        at = np.zeros(len(bits), dtype=np.int64)
        for depth in range(deep + 1):
            here = length == depth if depth < deep else length >= deep
            out[here] = self.shares[depth][at[here]]
            if depth < deep:
                at = 2 * at + bits[:, depth]
        return out / 2.0 ** np.maximum(length - deep, 0)


def fit_hashes(sample: np.ndarray, dimension: int, number: int, seed: int) -> Hashes:
    """The hashes of pass ``number``, placed by a sample of unit vectors (plain signs for none)."""
    normals = planes(number, dimension, seed)
    rows = len(sample)
    on = sample @ normals
    at = np.zeros(rows, dtype=np.int64)
    cuts, shares = [], [np.ones(1)]
    while rows >= 2 * LEAF << len(cuts):
        depth = len(cuts)
        order = np.lexsort((on[:, depth], at))
        sizes = np.bincount(at, minlength=1 << depth)
        middle = np.minimum(np.cumsum(sizes) - sizes + sizes // 2, rows - 1)
        cuts.append(np.where(sizes > 0, on[order[middle], depth], 0.0))
        at = 2 * at + (on[:, depth] >= cuts[-1][at])
        shares.append(np.bincount(at, minlength=2 << depth) / rows)
    deep = len(cuts)
    sizes = np.bincount(at, minlength=1 << deep)
    centres = np.zeros((1 << deep, BITS - deep))
    np.add.at(centres, at, on[:, deep:])
    return Hashes(normals, cuts, centres / np.maximum(sizes, 1)[:, None], shares)


def plan_passes(
    sample: np.ndarray, rows: float, window: int, threshold: float, recall: float, seed: int,
    trials: int = 2048, most: int = 4096,
) -> int:
    """Passes after which ``recall`` of the pairs right at ``threshold`` have shared a window.

    Tried out on sampled vectors, each with a partner made at that cosine: a pass surely brings
    both into a window if no more than ``window`` of all ``rows`` agree in the hashes they share.
    """
    if rows <= window:
        return 1
    x = sample[:trials]
    rng = np.random.default_rng([seed, len(x)])
    y = rng.standard_normal(x.shape)
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-12)
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold**2)) * y
    apart = np.ones(len(x), dtype=bool)
    for number in range(most):
        hashes = fit_hashes(sample, x.shape[1], number, seed)
        bits = hashes.bits(x)
        differ = bits != hashes.bits(y)
        shared = np.where(differ.any(axis=1), differ.argmax(axis=1), BITS)
        apart &= hashes.share(bits, shared) * rows > window
        if apart.mean() <= 1 - recall:
            return number + 1
    raise ValueError(f"{most} passes do not reach a recall of {recall}: widen the window")


def _packed(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """``vec_id, node, raw, dim``: digest and bytes of each vector, null if it links with nothing."""
    cast = vectors.select(
        F.col(id_).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, raws, dims = [], [], []
            for v in batch.column("v"):
                x = None
                if v.is_valid and len(v) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype("<f8")
                    x = x if np.isfinite(x).all() and x.any() else None
                raw = None if x is None else (x + 0.0).tobytes()  # -0.0 is 0.0
                raws.append(raw)
                nodes.append(raw and hashlib.md5(raw).digest())
                dims.append(0 if x is None else len(x))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), pa.array(nodes, pa.binary()),
                    pa.array(raws, pa.binary()), pa.array(dims, pa.int32()),
                ],
                names=["vec_id", "node", "raw", "dim"],
            )

    return cast.mapInArrow(run, "vec_id long, node binary, raw binary, dim int")


def _projected(distinct: DataFrame, first: int, last: int, hashes: dict, seed: int) -> DataFrame:
    """Every vector once a pass, with its sort key: its hashes, concatenated.

    ``hashes`` by pass and dimension; dimensions that are in no sample have plain signs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                x = unit(own.column("raw"), int(dim))
                for number in range(first, last):
                    fitted = hashes.get((number, int(dim)))
                    if fitted is None:
                        fitted = fit_hashes(np.zeros((0, int(dim))), int(dim), number, seed)
                    order = np.packbits(fitted.bits(x), axis=1)
                    keys = pa.array([row.tobytes() for row in order], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(x), number, np.int32)), own.column("dim"), keys,
                            own.column("node"), own.column("raw"),
                        ],
                        names=["pass", "dim", "order", "node", "raw"],
                    )

    return distinct.select("node", "raw", "dim").mapInArrow(
        run, "pass int, dim int, order binary, node binary, raw binary"
    )


_FOUND = pa.schema(
    [
        ("a", pa.binary()), ("b", pa.binary()), ("part", pa.int32()), ("side", pa.int32()),
        ("place", pa.int32()), ("rows", pa.int64()), ("pass", pa.int32()), ("dim", pa.int32()),
        ("raw", pa.binary()),
    ]
)
_FOUND_DDL = (
    "a binary, b binary, part int, side int, place int, rows long, `pass` int, dim int, raw binary"
)


def _window_edges(table: pa.Table, window: int, threshold: float,
                  until: int | None = None) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the verified pairs at most ``window`` rows apart, in one sorted table.

    ``until``: only pairs of a row before it and one from it on.
    """
    n = table.num_rows
    numbers, dims = table.column("pass").to_numpy(), table.column("dim").to_numpy()
    change = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(dims) != 0)) + 1
    i_all, j_all = [], []
    for a, b in zip([0, *change], [*change, n]):
        x = unit(table.column("raw").slice(a, b - a), int(dims[a]))
        for start in range(0, len(x), window):
            rows = x[start : start + window]
            near, to = np.nonzero(rows @ x[start : start + 2 * window].T >= threshold)
            keep = (to > near) & (to - near <= window)
            i_all.append(near[keep] + (a + start))
            j_all.append(to[keep] + (a + start))
    if not i_all:
        return []
    i, j = np.concatenate(i_all), np.concatenate(j_all)
    if until is not None:
        keep = (i < until) & (j >= until)
        i, j = i[keep], j[keep]
    low = local_components(n, i, j)
    nodes = table.column("node").to_pylist()
    return [(nodes[k], nodes[low[k]]) for k in np.flatnonzero(low != np.arange(n))]


def _pass_edges(distinct: DataFrame, first: int, last: int, window: int, threshold: float,
                hashes: dict, seed: int) -> DataFrame:
    """Edges of some passes: windows inside the tasks, then those over the borders of tasks."""
    order = ["pass", "dim", "order", "node"]
    rows = _projected(distinct, first, last, hashes, seed)
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: pa.Table | None = None  # the last rows, for the next batch
        ahead: list[pa.Table] = []  # the first rows of the task
        seen = 0

        def border(table: pa.Table, side: int) -> pa.RecordBatch:
            n = table.num_rows
            place = np.arange(n, dtype=np.int32)  # how far from the border
            return pa.RecordBatch.from_arrays(
                [
                    table.column("node").combine_chunks(), pa.nulls(n, pa.binary()),
                    pa.array(np.full(n, part, np.int32)), pa.array(np.full(n, side, np.int32)),
                    pa.array(place if side else place[::-1]), pa.array(np.full(n, seen)),
                    table.column("pass").combine_chunks(), table.column("dim").combine_chunks(),
                    table.column("raw").combine_chunks(),
                ],
                schema=_FOUND,
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch]).select(["pass", "dim", "node", "raw"])
            if seen < window:
                ahead.append(now.slice(0, window - seen))
            seen += now.num_rows
            table = now if held is None else pa.concat_tables([held, now])
            table = table.combine_chunks()
            edges = _window_edges(table, window, threshold)
            if edges:
                a, b = zip(*edges)
                none = [pa.nulls(len(a), f.type) for f in list(_FOUND)[2:]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(b, pa.binary()), *none], schema=_FOUND
                )
            held = table.slice(max(0, table.num_rows - window))
        if held is not None:
            yield border(pa.concat_tables(ahead).combine_chunks(), 1)
            yield border(held.combine_chunks(), 0)

    found = stage(placed.mapInArrow(run, _FOUND_DDL), "passes")
    inner = found.filter("part is null").select("a", "b")
    seams = _seams(
        # number of tasks, not of vectors: the tasks that had rows, in order
        sorted(tuple(r) for r in found.filter("part is not null").select("part", "rows").distinct().collect()),
        window,
    )
    if not seams:
        return inner
    seam = distinct.sparkSession.createDataFrame(seams, "part int, side int, seam int, shift long")
    names = ["seam", "side", "place"]
    borders = found.filter("part is not null").join(F.broadcast(seam), ["part", "side"])
    # the rows before a border in their order, then those behind it
    far = F.col("place") + F.col("shift")
    placed = borders.filter(far < window).select(
        "seam", "side", F.when(F.col("side") == 0, -far).otherwise(far).alias("place"),
        "pass", "dim", F.col("a").alias("node"), "raw",
    )
    placed = placed.repartition("seam").sortWithinPartitions(*names)

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups_of(batches, ["seam"]):
            until = int((table.column("side").to_numpy() == 0).sum())
            edges = _window_edges(table, window, threshold, until)
            if edges:
                a, b = zip(*edges)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"]
                )

    return inner.union(placed.mapInArrow(across, "a binary, b binary"))


def _seams(parts: list[tuple[int, int]], window: int) -> list[tuple[int, int, int, int]]:
    """Which tasks reach over which border: ``part, side, seam, shift``.

    A window may span tasks of few rows, so a border sees as many tasks on both sides as hold
    ``window`` rows; ``shift`` is how many rows lie between the task and the border.
    """
    out = []
    for seam in range(len(parts) - 1):
        for side, reach in ((0, range(seam, -1, -1)), (1, range(seam + 1, len(parts)))):
            shift = 0
            for at in reach:
                if shift >= window:
                    break
                out.append((parts[at][0], side, seam, shift))
                shift += parts[at][1]
    return out


def _linked(threshold: float):
    def links(group: pa.Table, left: np.ndarray, right: np.ndarray):
        x = unit(group.column("raw"), group.column("dim")[0].as_py())
        i, j = np.nonzero(x[left] @ x[right].T >= threshold)
        return left[i], right[j]

    return links


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.9,
    window: int = 256,
    recall: float = 0.999,
    passes_at_once: int = 8,
    chunk: int = 1024,
    sample: int = 8192,
    seed: int = 7,
    id_: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``.

    Equal vectors are one while passes run. Each pass sorts all vectors by their concatenated
    hashes over all tasks and verifies those at most ``window`` rows apart, also across the
    borders of tasks. The planes of the hashes are placed by a sample of at most ``sample``
    vectors, so that vectors that crowd (one topic, or a common mean) are told apart like any
    others; the number of passes is the one that brings ``recall`` of pairs right at the
    threshold into a window, tried out on the same sample. All vectors are in all passes, at
    every size. Verified pairs are united to components. Then all vectors of a component are
    compared in blocks, so that ``n_links`` counts every pair in it, also of groups larger than a
    window.

    Vectors that are null, empty, zero or hold null or non-finite numbers link with nothing, nor
    do vectors of different dimensions. Repeated rows are linked copies. ``component_id`` is the
    smallest id in the component; a null id is never it unless it is alone. An empty table gives
    no rows; other columns are not read.
    """
    ready(vectors.sparkSession)
    packed = stage(_packed(vectors, id_, vector), "vectors")
    distinct = stage(
        packed.filter("node is not null").groupBy("node").agg(
            F.first("raw").alias("raw"), F.first("dim").alias("dim"),
            F.count("*").alias("copies"), F.min("vec_id").alias("low_id"),
        ),
        "distinct",
    )
    state = distinct.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    size, valid = state
    fitted = _sampled(distinct, sample) if size else {}
    taken = sum(len(x) for x in fitted.values())
    # a dimension of more rows than these would be in the sample
    passes = passes_needed(8 * size / taken, window, threshold, recall) if size > taken else 1
    for x in fitted.values():
        share = len(x) / taken * size
        passes = max(passes, plan_passes(x, share, window, threshold, recall, seed))
    edges = distinct.select(F.col("node").alias("a"), F.col("node").alias("b"))
    for first in range(0, passes if size else 0, passes_at_once):
        last = min(first + passes_at_once, passes)
        hashes = {
            (number, dim): fit_hashes(x, dim, number, seed)
            for number in range(first, last) for dim, x in fitted.items()
        }
        found = _pass_edges(distinct, first, last, window, threshold, hashes, seed)
        edges = edges.union(found)
    roots = stage(components(edges.distinct()), "roots")
    members = distinct.join(roots.withColumnRenamed("root", "group"), "node")
    paired = chunk_pairs(
        members.withColumn("size", F.length("raw")), chunk, "size", chunk * 8192 * 8
    )
    near = (
        count_links(paired, _linked(threshold), ["raw", "dim"])
        .groupBy("node").agg(F.sum("near").alias("near"))
    )
    lowest = (
        roots.join(distinct.select("node", "low_id"), "node")
        .groupBy("root").agg(F.min("low_id").alias("component"), F.count("*").alias("n"))
    )
    # vectors without links are in no table of roots: they never share a join key
    named = meet(roots, lowest, "root", "n", size).select("node", "component")
    known = (
        distinct.select("node", "copies", "low_id")
        .join(named, "node", "left").join(near, "node", "left")
        .select(
            "node", "copies", F.coalesce("component", "low_id").alias("component"),
            (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
        )
    )
    rows = packed.select("vec_id", "node")
    alone = rows.filter("node is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component")
    )
    names = ["vec_id", "n_links", "component"]
    found = meet(rows.filter("node is not null"), known, "node", "copies", valid)
    every = found.select(*names).union(alone)
    return every.select(
        "vec_id", F.col("n_links").cast("long").alias("n_links"),
        F.coalesce("component", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("component", "vec_id")).alias("kept"),
    )


def _sampled(distinct: DataFrame, most: int) -> dict[int, np.ndarray]:
    """Unit vectors by dimension: the ``most`` of the smallest digests, the same in every run."""
    rows = distinct.orderBy("node").limit(most).select("dim", "raw").collect()
    raws: dict[int, list[bytes]] = {}
    for dim, raw in rows:
        raws.setdefault(dim, []).append(bytes(raw))
    return {dim: unit(pa.array(own, pa.binary()), dim) for dim, own in sorted(raws.items())}
