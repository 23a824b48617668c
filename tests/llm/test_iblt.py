import hashlib
import re

import pytest
from pyspark.sql import functions as F

from benchbook.llm import iblt
from tests.llm.conftest import prose


def sets(text):
    lines = {x.strip(" ") for x in text.split("\n")} - {""}
    sentences = words = None
    if len(lines) < iblt.FEW:
        sentences = set(re.findall(r"(?:\S*[^\s.!?][ \t]+){0,15}\S+", text, re.A))
    if sentences is not None and len(sentences) < iblt.FEW:
        words = {x for x in re.split(r"[ \t\n]+", text) if x}
    return lines, sentences, words


def likeness(a, b):
    x, y = next(p for p in list(zip(a, b))[::-1] if p[0] is not None and p[1] is not None)
    return len(x & y) / len(x | y) if x | y else 1.0


def expected(rows):
    """By brute force: the edited text, and the likeness of the sets themselves."""
    unique = sorted(
        {(i, t or "") for i, t in rows},
        key=lambda r: (-(r[0] if r[0] is not None else -1),
                       hashlib.md5(f"{'null' if r[0] is None else r[0]}/{r[1]}".encode()).hexdigest()),
    )
    out = {}
    for at, (i, text) in enumerate(unique):
        after = unique[(at + 1) % len(unique)][1]
        m = len(text) // 3
        edited = text[: len(text) - m] + after[:m]
        out[i, len(text), hashlib.sha256(edited.encode()).hexdigest()] = (
            likeness(sets(text), sets(edited)), likeness(sets(text), sets(after))
        )
    return out


def check(df):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    want = expected(rows)
    got = iblt.fingerprint_versions(df).collect()
    assert len(got) == len(rows)
    for r in got:
        edited, after = want[r["doc_id"], r["n_chars"], r["edited_sha256"]]
        assert r["near_edited"] == pytest.approx(edited) and r["near_next"] == pytest.approx(after)
    return got


def test_against_brute_force(spark):
    texts = [prose(i, n) for i, n in enumerate([3, 20, 80, 400, 2000, 9000])]
    texts += [texts[3], texts[3].replace("w1", "v1", 1), "\n".join(texts[4].split())]
    df = spark.createDataFrame([(7 * i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = check(df.repartition(4))
    by = {r["doc_id"]: r for r in rows}
    assert by[21]["fingerprint"] == by[42]["fingerprint"] != by[49]["fingerprint"]
    assert by[49]["near_next"] == 1.0 or by[49]["near_next"] > 0.9  # next is the text it came from


def test_odd_tables(odd_docs, no_docs, spark):
    check(odd_docs)
    assert iblt.fingerprint_versions(no_docs).count() == 0
    one = spark.createDataFrame([(1, "a b c d e f g h i")], "doc_id long, text string")
    assert check(one)[0]["near_next"] == 1.0


def test_differences_come_out(spark):
    """Peeling gives back exactly the digests in which two sets differ, of any size."""
    rows = []
    for n, apart in [(0, 0), (5, 0), (0, 4), (40, 3), (40, 60), (3000, 10), (3000, 3000)]:
        same = [f"same{i}" for i in range(n)]
        rows.append((same + [f"l{i}" for i in range(apart)], same + [f"r{i}" for i in range(apart // 2)]))
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    hashed = df.select(*[F.transform(c, lambda x: F.xxhash64(x)).alias(c) for c in "ab"])
    for r in iblt.difference(hashed, "a", "b", "d").collect():
        a, b = set(r["a"]), set(r["b"])
        assert {(1, k) for k in a - b} | {(-1, k) for k in b - a} == {(x["n"], x["k"]) for x in r["d"]}


def test_too_small_a_sketch_fails_and_a_larger_one_does_not(spark):
    df = spark.range(1).selectExpr("transform(sequence(1, 40), i -> xxhash64(i)) AS a",
                                   "cast(array() as array<bigint>) AS b")
    tries = [
        F.expr(iblt.peeled(iblt.subtracted(iblt.cells("a", s), iblt.cells("b", s)), s)).alias(f"s{s}")
        for s in (4, 64)
    ]
    row = df.select("a", *tries).first()
    assert row["s4"] is None and sorted(x["k"] for x in row["s64"]) == sorted(row["a"])


def test_no_python_in_the_plan(spark, odd_docs):
    plan = iblt.fingerprint_versions(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
