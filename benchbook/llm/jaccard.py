"""N-gram Jaccard join: MinHash bands find candidates, full n-gram sets decide."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from benchbook.llm.blocks import chunk_pairs, count_links
from benchbook.llm.common import components, meet, ready, slices, stage, text_of, unused
from benchbook.llm.words import Hashes, mixed, shingles


def bands_and_rows(threshold: float, recall: float, most_hashes: int = 160) -> tuple[int, int]:
    """Bands and rows a band: the longest rows for which ``most_hashes`` give the recall.

    A pair of similarity s shares a band with probability 1 - (1 - s**rows)**bands; more rows let
    fewer unlike pairs through.
    """
    best = (most_hashes, 1)
    for rows in range(1, 33):
        once = threshold**rows
        bands = math.ceil(math.log(1 - recall) / math.log(1 - once)) if once < 1 else 1
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best


def _sets(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    cuts = np.cumsum(counts)
    return [np.unique(values[b - n : b]) for b, n in zip(cuts, counts)]


def _band_keys(values: np.ndarray, counts: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key a text and band; texts must have at least one n-gram."""
    rng = np.random.default_rng(11)
    factors = rng.integers(1, 1 << 62, size=bands * rows).astype(np.uint64) * np.uint64(2)
    factors += np.uint64(1)
    starts = np.cumsum(counts) - counts
    out = np.empty((len(counts), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(counts), np.uint64(band + 1))
        for factor in factors[band * rows : (band + 1) * rows]:
            key = mixed(key + np.minimum.reduceat(values * factor, starts))
        out[:, band] = key
    return out


def _signed(df: DataFrame, bands: int, rows: int, width: int) -> DataFrame:
    """``doc_id, copy, node, bands, size`` of ``doc_id, text, copy``: what a text is a member of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for whole in batches:
            for batch in slices(whole, "text"):
                values, counts = shingles(*hashes.of(batch.column("text").to_pylist()), width)
                sets = _sets(values, counts)
                nodes = [hashlib.md5(s.tobytes()).digest() for s in sets]
                some = np.flatnonzero(counts)
                keys = np.empty((0, bands), dtype=np.uint64)
                if len(some):
                    keys = _band_keys(values, counts[some], bands, rows)
                offsets = np.concatenate([[0], np.cumsum(np.where(counts > 0, bands, 0))])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), batch.column("copy"), pa.array(nodes, pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(offsets, pa.int32()),
                            pa.array(keys.ravel().view(np.int64), pa.int64()),
                        ),
                        pa.array([len(s) for s in sets], pa.int64()),
                    ],
                    names=["doc_id", "copy", "node", "bands", "size"],
                )

    kinds = "doc_id long, copy string, node binary, bands array<long>, size long"
    return df.select("doc_id", "copy", "text").mapInArrow(run, kinds)


def _with_sets(df: DataFrame, width: int) -> DataFrame:
    """``text`` of each row replaced by its packed n-gram set ``grams``."""
    others = [c for c in df.columns if c != "text"]
    kinds = ", ".join(f"`{n}` {k}" for n, k in df.select(*others).dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for whole in batches:
            for batch in slices(whole, "text"):
                values, counts = shingles(*hashes.of(batch.column("text").to_pylist()), width)
                packed = pa.array([s.tobytes() for s in _sets(values, counts)], pa.binary())
                columns = [batch.column(c) for c in others]
                yield pa.RecordBatch.from_arrays([*columns, packed], names=[*others, "grams"])

    return df.select(*others, "text").mapInArrow(run, f"{kinds}, grams binary")


def _verified(threshold: float, cells: int = 4_000_000):
    """Links of a block by full sets: n-grams shared by each pair, as products of 0/1 matrices."""

    def links(group: pa.Table, left: np.ndarray, right: np.ndarray):
        sets = [np.frombuffer(g, dtype=np.uint64) for g in group.column("grams").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, column, times = np.unique(
            np.concatenate(sets), return_inverse=True, return_counts=True
        )
        common = times > 1  # the others are shared by nobody
        keep = common[column]
        column, owner = (np.cumsum(common) - 1)[column[keep]], owner[keep]
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        shared = np.zeros((len(left), len(right)), dtype=np.float32)
        step, last = max(1, cells // len(sets)), int(common.sum())
        for at in range(0, last, step):
            lo, hi = np.searchsorted(column, [at, at + step])
            dense = np.zeros((len(sets), min(step, last - at)), dtype=np.float32)
            dense[owner[lo:hi], column[lo:hi] - at] = 1
            shared += dense[left] @ dense[right].T
        union = sizes[left][:, None] + sizes[right][None, :] - shared
        i, j = np.nonzero(shared >= threshold * union - 1e-9)
        return left[i], right[j]

    return links


def near_documents(
    docs: DataFrame,
    threshold: float = 0.8,
    width: int = 5,
    recall: float = 0.999,
    chunk: int = 1024,
    chunk_grams: int = 1_500_000,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id, copy, class_id, n_links, kept``.

    Words are lower-cased and split at white space; a text is its set of runs of ``width`` words
    (all its words, if it has fewer). Documents with equal sets are one node with a number of
    copies. Nodes that share a MinHash band are candidates: each band's nodes are linked to its
    smallest one, a number of links that grows with the nodes and not with their pairs, and the
    components of that are compared in blocks, every pair on its full sets. ``n_links`` counts
    the other documents with a similarity of ``threshold`` or more in the component, copies each;
    ``class_id`` is the smallest id reachable over such links. ``copy`` is the MD5 of the text and
    ``kept`` marks the row of a class with the smallest id (then the smallest ``copy``); repeated
    rows of it are marked alike. Null ids come last.

    Texts without words, null or empty, are copies of each other. Texts are read twice: all for
    their bands, and one text of each candidate node for its set. Nothing but counters comes to
    the driver. An empty table gives no rows; other columns are not read.
    """
    ready(docs.sparkSession)
    bands, rows = bands_and_rows(threshold, recall)
    body = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    body = body.withColumn("copy", F.md5("text"))
    signed = stage(_signed(body, bands, rows, width), "signed")
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "copy")
    nodes = stage(
        signed.groupBy("node").agg(
            F.count("*").alias("copies"), F.min(first).alias("rep"),
            F.first("bands").alias("bands"), F.first("size").alias("size"),
        ),
        "nodes",
    )
    banded = nodes.select("node", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("node").alias("hub"), F.count("*").alias("n"))
    edges = banded.join(hubs.filter("n > 1"), "band").select(
        F.col("node").alias("a"), F.col("hub").alias("b")
    )
    groups = stage(components(edges), "groups")
    members = groups.select("node", F.col("root").alias("group")).join(
        nodes.select("node", "copies", "rep.doc_id", "rep.copy", "size"), "node"
    )
    wanted = members.withColumnRenamed("doc_id", "_id").withColumnRenamed("copy", "_copy")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("copy") == F.col("_copy"))
    texts = body.join(wanted, same).dropDuplicates(["node"])
    sets = _with_sets(texts.select("group", "node", "copies", "size", "text"), width)
    paired = chunk_pairs(stage(sets, "sets"), chunk, "size", chunk_grams)
    found = stage(count_links(paired, _verified(threshold), ["grams"]), "links")
    near = found.groupBy("node").agg(F.sum("near").alias("near"))
    classes = components(found.select(F.col("node").alias("a"), F.col("low").alias("b")))
    classes = stage(classes.withColumnRenamed("root", "class"), "classes")
    lowest = (
        nodes.select("node", "rep").join(classes, "node")
        .groupBy("class").agg(F.min("rep").alias("class_rep"), F.count("*").alias("n"))
    )
    total = nodes.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    # nodes alone in their class are in no table of classes: they never share a join key
    named = meet(classes, lowest, "class", "n", total).select("node", "class_rep")
    known = (
        nodes.select("node", "copies", "rep")
        .join(named, "node", "left").join(near, "node", "left")
        .select(
            "node", "copies", F.coalesce("class_rep", "rep").alias("chosen"),
            (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).cast("long").alias("n_links"),
        )
    )
    chosen = F.col("doc_id").eqNullSafe(F.col("chosen.doc_id")) & (
        F.col("copy") == F.col("chosen.copy")
    )
    every = meet(signed.select("doc_id", "copy", "node"), known, "node", "copies", total)
    return every.select(
        "doc_id", "copy", F.col("chosen.doc_id").alias("class_id"), "n_links",
        chosen.alias("kept"),
    )


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """The documents without near copies: of each class the row that ``near_documents`` keeps.

    All columns of ``docs`` stay. Of rows that repeat with their id and text one stays.
    """
    doc_id, text = how.get("doc_id", "doc_id"), how.get("text", "text")
    own, id_, copy = (unused(docs, name) for name in ("md5", "kept_id", "kept_copy"))
    found = near_documents(docs, **how).filter("kept").select(
        F.col("doc_id").alias(id_), F.col("copy").alias(copy)
    ).distinct()
    marked = docs.withColumn(own, F.md5(text_of(text)))
    same = marked[doc_id].cast("long").eqNullSafe(found[id_]) & (marked[own] == found[copy])
    chosen = marked.join(found, same, "left_semi").dropDuplicates([doc_id, own])
    return chosen.select(*[F.col(f"`{c}`") for c in docs.columns])
