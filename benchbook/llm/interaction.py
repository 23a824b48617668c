"""How filters interact: what each removes in every order, and its Shapley share, exactly.

A document counts by the set of filters it fails, so a part (a source, say) is described by at
most 2**m numbers. From them come the removals of all coalitions of filters; a step of an order
is the difference of two coalitions. The Shapley value is the solution of a weighted least
squares problem over all coalitions with the shares bound to add up to the whole. Its normal
equations hold no data on their left side, so they are solved once, in rationals, for every
coalition's unit vector, and the solution is applied to each part's coalition table in whole
numbers: ``m!`` times a share is one.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from benchbook.llm.common import ready, slices, stage, text_of

#: Few words, repeated words, capitals, signs, a copy of an earlier document.
LETTERS = "ABCDE"
_UPPER = bytes(range(0x41, 0x5B))
_SIGNS = re.compile(rb"[#$%&*|]")


def text_failures(text: str) -> int:
    """Which of the first four filters a text fails, as bits: A is 1, B 2, C 4, D 8."""
    raw = text.encode()
    words = raw.split()  # at ASCII white space, as bytes split
    capitals = len(raw) - len(raw.translate(None, _UPPER))
    fails = (
        len(words) < 200,
        100 * len(set(words)) < 50 * len(words),
        100 * capitals > 2 * len(text),
        _SIGNS.search(raw) is not None,
    )
    return sum(1 << i for i, failed in enumerate(fails) if failed)


def solved_normal_equations(m: int) -> list[list[Fraction]]:
    """Row i, column S: what the removal of coalition S adds to the share of filter i.

    Minimises over all coalitions but the empty and the full one the squared difference of a
    coalition's removal and the sum of its shares, weighted by
    ``(m - 1) / (C(m, |S|) |S| (m - |S|))``, with the shares adding up to the full removal. The
    equations with their multiplier are reduced in fractions, so nothing is rounded.
    """
    full = (1 << m) - 1
    inside = [[s >> i & 1 for i in range(m)] for s in range(full + 1)]
    weight = [
        Fraction(m - 1, math.comb(m, k) * k * (m - k)) if 0 < (k := sum(bits)) < m else Fraction(0)
        for bits in inside
    ]
    rows = []
    for i in range(m):
        left = [
            sum((w for w, bits in zip(weight, inside) if bits[i] and bits[j]), Fraction(0))
            for j in range(m)
        ]
        rows.append([*left, Fraction(1), *(w * bits[i] for w, bits in zip(weight, inside))])
    rows.append([Fraction(1)] * m + [Fraction(0)] + [Fraction(int(s == full)) for s in range(full + 1)])
    for i in range(m + 1):
        pivot = next(r for r in range(i, m + 1) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(m + 1):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [row[m + 1 :] for row in rows[:m]]


def document_failures(
    docs: DataFrame, text: str = "text", key: str = "doc_id", part: str = "source"
) -> DataFrame:
    """``doc_id, part, mask, digest``: each document's failures of A to D, and its text's SHA-256.

    One pass over the texts, which do not leave it. Null texts count as empty, null parts as the
    empty string; all other columns are left behind, whatever their names.
    """
    ready(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"), text_of(f"`{part}`").alias("part"),
        text_of(f"`{text}`").alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                texts = batch.column("text").to_pylist()
                masks = pa.array([text_failures(t) for t in texts], type=pa.int32())
                digests = [hashlib.sha256(t.encode()).digest() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("part"), masks,
                     pa.array(digests, type=pa.binary())],
                    names=["doc_id", "part", "mask", "digest"],
                )

    return rows.mapInArrow(run, f"doc_id {kind}, part string, mask int, digest binary")


def counted_failures(rows: DataFrame, labels: DataFrame, copy_bit: int = 16) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by the filters they fail, copies included.

    A document is a copy if some smaller id has its text; one without an id neither is a copy nor
    makes one. Each digest is reduced to its smallest id before the shuffle, and looked up by
    digest and id: copies of one text, however many, have different ids and lie in different
    places. Repeated rows are counted before they are moved, and rows without an id go past both
    joins. Labels of an id count as set if any of its rows sets them; nulls do not.
    """
    same = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))
    known = same.filter(F.col("doc_id").isNotNull())
    first = (
        rows.filter(F.col("doc_id").isNotNull()).groupBy("digest")
        .agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    )
    marked = (
        labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"),
            F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
        )
    )
    copy = F.when(F.col("first").isNull(), copy_bit).otherwise(0)
    found = known.join(first, ["doc_id", "digest"], "left").join(marked, "doc_id", "left").select(
        "part", F.col("mask").bitwiseOR(copy).alias("mask"), "n",
        *[(F.coalesce(c, F.lit(0)) * F.col("n")).alias(c) for c in ("good", "toxic")],
    )
    nameless = same.filter(F.col("doc_id").isNull()).select(
        "part", "mask", "n", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic")
    )
    sums = [F.sum(c).alias(c) for c in ("n", "good", "toxic")]
    return found.union(nameless).groupBy("part", "mask").agg(*sums)


def coalition_removals(counted: DataFrame, m: int) -> DataFrame:
    """``part, coalition, total, removed, good, toxic``: what each set of filters removes together.

    Every part has all ``2**m`` coalitions, the empty one included, which removes nothing.
    """
    each = counted.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << m) - 1))))
    hit = F.col("coalition").bitwiseAND(F.col("mask")) != 0

    def summed(c: str) -> Column:
        return F.sum(F.when(hit, F.col(c)).otherwise(0))

    return each.groupBy("part", "coalition").agg(
        F.sum("n").alias("total"), summed("n").alias("removed"), summed("good").alias("good"),
        summed("toxic").alias("toxic"),
    )


def _steps(letters: str) -> list[tuple[str, int, int, int]]:
    """Order, step, its filter and the filters before it, the last as bits."""
    out = []
    for order in itertools.permutations(range(len(letters))):
        name, before = "".join(letters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            out.append((name, step, i, before))
            before |= 1 << i
    return out


def steps_of_orders(coalitions: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Every order of the filters, step by step, out of the coalition table of each part.

    ``letters`` names the filters, at most seven of them, as the orders are ``m!``. A part's
    table is one row of ``2**m`` numbers; all counts are differences of its entries.
    """
    m, steps = len(letters), _steps(letters)
    if m > 7:
        raise ValueError("orders of more than seven filters are too many to list")
    full, whole = (1 << m) - 1, math.factorial(m)
    weights = [[int(x * whole) for x in row] for row in solved_normal_equations(m)]
    names, numbers, filters, before = map(list, zip(*steps))
    entry = F.struct("coalition", "removed", "good", "toxic")
    tables = coalitions.groupBy("part").agg(
        F.max("total").alias("total"), F.array_sort(F.collect_list(entry)).alias("t")
    )
    shares = F.array(
        *[
            F.aggregate(
                F.zip_with(F.col("t.removed"), F.lit(row), lambda v, w: v * w.cast("long")),
                F.lit(0).cast("long"), lambda a, b: a + b,
            )
            for row in weights
        ]
    )
    numbered = F.explode(F.sequence(F.lit(0), F.lit(len(steps) - 1)))
    rows = tables.withColumn("shares", shares).withColumn("at", numbered)

    def listed(values: list) -> Column:
        return F.get(F.lit(values), F.col("at"))

    rows = rows.select(
        "*", listed(names).alias("filter_order"), listed(numbers).cast("int").alias("step"),
        listed(filters).alias("i"), listed([1 << i for i in filters]).alias("bit"),
        listed(before).alias("before"),
    )

    def of(column: str, coalition: Column) -> Column:
        return F.get(F.col(f"t.{column}"), coalition)

    past, after = F.col("before"), F.col("before").bitwiseOR(F.col("bit"))
    removed = of("removed", after) - of("removed", past)
    return rows.select(
        "part", "filter_order", "step",
        (F.col("total") - of("removed", after)).alias("kept"),
        removed.alias("removed"),
        (of("removed", F.col("bit")) - removed).alias("redundant"),
        (of("removed", F.lit(full)) - of("removed", F.lit(full) - F.col("bit"))).alias("unique_fails"),
        (of("good", after) - of("good", past)).alias("good_lost"),
        (of("toxic", after) - of("toxic", past)).alias("toxic_lost"),
        F.get("shares", F.col("i")).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters over whole documents, by part, order and step.

    The narrow rows of the one pass over the texts are written to the shared folder and read by
    what follows. An empty table has no parts and no rows.
    """
    rows = stage(document_failures(docs), "failures")
    counted = counted_failures(rows, labels)
    return steps_of_orders(coalition_removals(counted, len(LETTERS)))


CHECK_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
    length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals,
    min(doc_id) OVER (PARTITION BY t) < doc_id AS later FROM d),
l AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY 1),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
    + 4 * (100 * capitals > 2 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * coalesce(later, FALSE)::INT AS mask FROM w LEFT JOIN l USING (doc_id)),
h AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
letter(c, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT concat(v.c, w.c, x.c, y.c, z.c) AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bits
  FROM letter v, letter w, letter x, letter y, letter z
  WHERE len(list_distinct([v.c, w.c, x.c, y.c, z.c])) = 5),
steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0)::INT AS before
  FROM (SELECT *, unnest(range(1, 6)) AS step FROM orders)),
r AS (
  SELECT part, filter_order, step, bit, sum(n) FILTER (mask & (before | bit) = 0) AS kept,
    sum(n) FILTER (mask & bit > 0 AND mask & before = 0) AS removed,
    sum(n) FILTER (mask & bit > 0 AND mask & before > 0) AS redundant,
    sum(n) FILTER (mask = bit) AS unique_fails,
    sum(good) FILTER (mask & bit > 0 AND mask & before = 0) AS good_lost,
    sum(toxic) FILTER (mask & bit > 0 AND mask & before = 0) AS toxic_lost
  FROM h, steps GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept,
  coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
  coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley FROM r"""
