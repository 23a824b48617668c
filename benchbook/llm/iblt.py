"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

Columns and joins only. A sketch has three tables of cells; a digest goes into one cell of each,
which keeps the number of digests, the exclusive or of them, and that of their check hashes. Two
versions of a document differ by what is left when one sketch is subtracted from the other. A
cell left with a single digest gives it away; taking it out of its other cells lays open more,
until all cells are empty. If that fails, sketches with more cells are made.

A fingerprint has a fixed number of cells. Where it is too small for a difference, the digests are
dealt to blocks by their upper bits, a few to a block, and each block gets a sketch of its own,
with more and more cells until it decodes. The work is in proportion to the number of digests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from benchbook.llm.common import stage, text_of

#: Below this many lines a text is also cut at sentences, below as many sentences at words.
FEW = 8
#: A sentence of a line, or its next sixteen words.
SENTENCE = r"(?:\\S*[^\\s.!?][ \\t]+){0,15}\\S+"
#: Digests of one version that a block is meant for, and the cells of a table in each attempt.
BLOCK, ATTEMPTS = 3, (4, 8, 16, 32, 64, 256, 1024)
#: Cells of a table of the fingerprint, and rounds of peeling.
CELLS, ROUNDS = 4, 12


def _distinct(pieces: str) -> str:
    return f"array_distinct(transform(filter({pieces}, p -> p != ''), p -> xxhash64(p)))"


def grains(text: str) -> Column:
    """Distinct digests of a text's lines, of its sentences and of its words.

    Sentences are null unless the text has few lines, words unless it has few sentences.
    """
    lines = f"transform(split({text}, '\\n'), p -> trim(p))"
    sentences = f"regexp_extract_all({text}, '{SENTENCE}', 0)"
    words = f"split({text}, '[ \\t\\n]+')"
    return F.expr(
        f"""element_at(transform(array({_distinct(lines)}), l ->
          element_at(transform(array(if(size(l) < {FEW}, {_distinct(sentences)}, null)), s ->
            named_struct('lines', l, 'sentences', s,
                         'words', if(size(s) < {FEW}, {_distinct(words)}, null))), 1)), 1)"""
    )


def cells(digests: str, s: int | str) -> str:
    """SQL of the cells of a sketch with three tables of ``s`` (a power of two) cells."""
    tables = ", ".join(
        f"transform(sequence(0, {s} - 1), i -> "
        f"filter({digests}, x -> (shiftright(x, {16 * t}) & ({s} - 1)) = i))"
        for t in range(3)
    )
    return f"""transform(flatten(array({tables})), f -> named_struct(
      'n', size(f), 'k', aggregate(f, 0L, (a, x) -> a ^ x),
      'c', aggregate(f, 0L, (a, x) -> a ^ xxhash64(x))))"""


def subtracted(a: str, b: str) -> str:
    return (
        f"zip_with({a}, {b}, (p, q) -> "
        "named_struct('n', p.n - q.n, 'k', p.k ^ q.k, 'c', p.c ^ q.c))"
    )


def peeled(difference: str, s: int) -> str:
    """SQL of the digests in a difference, ``array<struct<n, k>>`` (n: 1 left, -1 right); null
    if they do not come out."""
    own = f"(shiftright(p.k, 16 * (j div {s})) & ({s} - 1)) = j % {s}"
    step = f"""element_at(transform(
      array(array_distinct(transform(
        filter(st.cells, c -> abs(c.n) = 1 AND c.c = xxhash64(c.k)),
        c -> named_struct('n', c.n, 'k', c.k)))),
      pure -> if(size(pure) = 0, st, named_struct(
        'cells', transform(st.cells, (c, j) -> aggregate(filter(pure, p -> {own}), c,
            (a, p) -> named_struct('n', a.n - p.n, 'k', a.k ^ p.k, 'c', a.c ^ xxhash64(p.k)))),
        'found', concat(st.found, pure)))), 1)"""
    empty = "cast(array() as array<struct<n:int,k:bigint>>)"
    return f"""aggregate(sequence(1, {ROUNDS}),
      named_struct('cells', {difference}, 'found', {empty}),
      (st, r) -> {step},
      st -> if(forall(st.cells, c -> c.n = 0 AND c.k = 0 AND c.c = 0), st.found, null))"""


def blocks(digests: str, bits: str) -> str:
    """SQL of ``digests`` dealt to 2**bits blocks by their upper bits, in two steps."""
    low = f"({bits} div 2)"
    high = f"({bits} - {low})"
    return f"""flatten(transform(
      transform(sequence(0, shiftleft(1, {high}) - 1),
        i -> filter({digests}, x -> (shiftrightunsigned(x, 48 + {low})
                                     & (shiftleft(1, {high}) - 1)) = i)),
      f -> transform(sequence(0, shiftleft(1, {low}) - 1),
        i -> filter(f, x -> (shiftrightunsigned(x, 48) & (shiftleft(1, {low}) - 1)) = i))))"""


def difference(df: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Add ``array<struct<n, k>>``: the digests in only one of two columns of digest sets.

    ``n`` is 1 for those of ``left`` and -1 for those of ``right``. First from sketches of the
    fingerprint's size; where that fails, block by block, with growing sketches. Null if the
    largest ones fail too, which takes digests that agree in 48 bits.
    """
    small = peeled(subtracted(cells(left, CELLS), cells(right, CELLS)), CELLS)
    tries = ", ".join(peeled(subtracted(cells("a", s), cells("b", s)), s) for s in ATTEMPTS)
    bits = f"least(16, greatest(0, ceil(log2(greatest(size({left}), size({right})) / {BLOCK}))))"
    return (
        df.withColumn("_small", F.expr(small))
        .withColumn("_bits", F.when(F.col("_small").isNull(), F.expr(f"cast({bits} as int)")))
        .withColumn(
            "_blocks",
            F.expr(
                f"""if(_bits is null, null, zip_with({blocks(left, "_bits")},
                    {blocks(right, "_bits")}, (a, b) -> if(size(a) + size(b) = 0,
                      cast(array() as array<struct<n:int,k:bigint>>), coalesce({tries}))))"""
            ),
        )
        .withColumn(
            name,
            F.when(F.col("_bits").isNull(), F.col("_small")).when(
                F.forall("_blocks", lambda b: b.isNotNull()), F.flatten("_blocks")
            ),
        )
        .drop("_small", "_bits", "_blocks")
    )


def likeness(left: str, right: str, differing: str) -> Column:
    """Jaccard similarity of two digest sets from their sizes and the size of their difference.

    1 for two empty sets; 0 where the difference did not decode.
    """
    both, apart = F.size(left) + F.size(right), F.size(differing)
    return F.when(both == 0, 1.0).otherwise(
        F.coalesce((both - apart) / (both + apart), F.lit(0.0))
    )


def fingerprint(sets: str) -> Column:
    """Text form of the sketch of a text's finest digests: their number, then all cells."""
    finest = f"coalesce({sets}.words, {sets}.sentences, {sets}.lines)"
    return F.expr(
        f"""concat_ws('-', size({finest}), array_join(transform({cells(finest, CELLS)},
          c -> concat(c.n, '.', hex(c.k), '.', hex(c.c & 4294967295))), '-'))"""
    )


def _matched(left: str, right: str) -> tuple[Column, Column]:
    """Digests of both sides at the finest grain that both have."""
    words = F.col(f"{left}.words").isNotNull() & F.col(f"{right}.words").isNotNull()
    parts = F.col(f"{left}.sentences").isNotNull() & F.col(f"{right}.sentences").isNotNull()

    def side(name: str) -> Column:
        return (
            F.when(words, F.col(f"{name}.words")).when(parts, F.col(f"{name}.sentences"))
            .otherwise(F.col(f"{name}.lines"))
        )

    return side(left), side(right)


def compare(df: DataFrame, left: str, right: str, name: str) -> DataFrame:
    """Add the likeness of two columns of ``grains`` as ``name``."""
    a, b = _matched(left, right)
    both = df.withColumn("_a", a).withColumn("_b", b)
    found = difference(both, "_a", "_b", "_d")
    return found.withColumn(name, likeness("_a", "_b", "_d")).drop("_a", "_b", "_d")


def neighbours(ids: DataFrame) -> DataFrame:
    """``key, next, last_n, last``: of each ``key, doc_id, n`` the keys after and before it, by
    descending ``doc_id`` (nulls last), then ``key``, in a circle.

    Ids are dealt to ranges; inside a range the neighbour is the next row, at its ends the next
    range's. Only the ends of the ranges, two rows for each, are ordered in one place.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("key")]
    placed = stage(
        ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "order"
    )
    inside = Window.partitionBy("part").orderBy(*order)
    row = F.struct("key", "n")
    near = placed.withColumns({"up": F.lag(row).over(inside), "down": F.lead("key").over(inside)})
    ends = near.groupBy("part").agg(
        F.first(F.when(F.col("up").isNull(), F.col("key")), ignorenulls=True).alias("head"),
        F.first(F.when(F.col("down").isNull(), row), ignorenulls=True).alias("tail"),
    )
    ranges = Window.orderBy("part")
    whole = ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seams = ends.select(
        "part",
        F.coalesce(F.lead("head").over(ranges), F.first("head").over(whole)).alias("after"),
        F.coalesce(F.lag("tail").over(ranges), F.last("tail").over(whole)).alias("before"),
    )
    # one row a range: their number is that of tasks
    joined = near.join(F.broadcast(seams), "part")
    return joined.select(
        "key", F.coalesce("down", "after").alias("next"),
        F.coalesce("up", "before")["key"].alias("last"),
        F.coalesce("up", "before")["n"].alias("last_n"),
    )


def fingerprint_versions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are.

    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next``. The edited form has the last third of the text replaced by the beginning of the
    next document (descending id; after the last the first). A null text is empty; two empty texts
    are alike (1). Null ids come last, rows with one id are ordered by a hash of their text, and
    repeated rows are one document in that order but a row each in the result. An empty table
    gives no rows; other columns are not read.

    The texts move once, by a hash of id and text; the beginnings that neighbours need, a third at
    most, and their digests once more.
    """
    body = docs.select(F.col(doc_id).alias("doc_id"), text_of(text).alias("text"))
    name = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("/"), "text")
    keyed = body.withColumn("key", F.md5(name))
    ids = keyed.select("key", "doc_id", F.length("text").alias("n")).distinct()
    links = neighbours(ids)
    dealt = keyed.repartition("key")
    # ordered by a column that the other side needs too: both then read one exchange of texts
    first = Window.partitionBy("key").orderBy("doc_id")
    once = dealt.withColumn("_row", F.row_number().over(first)).filter("_row = 1")
    given = once.join(links.select("key", "last", "last_n"), "key").select(
        F.col("last").alias("key"),
        F.expr("left(text, cast(floor(last_n / 3) as int))").alias("start"),
        grains("text").alias("next_set"),
    )
    sets = (
        dealt.join(given, "key")
        .withColumn("n_chars", F.length("text").cast("long"))
        .withColumn(
            "edited",
            F.expr("concat(left(text, cast(n_chars - floor(n_chars / 3) as int)), start)"),
        )
        .withColumns({"own_set": grains("text"), "edited_set": grains("edited")})
        .select(
            "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
            "own_set", "edited_set", "next_set",
        )
    )
    printed = sets.withColumns(
        {"fingerprint": fingerprint("own_set"), "edited_fingerprint": fingerprint("edited_set")}
    )
    compared = compare(
        compare(printed, "own_set", "edited_set", "near_edited"), "own_set", "next_set", "near_next"
    )
    return compared.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next",
    )
