import random

import numpy as np
import pytest

from benchbook.llm import jaccard
from benchbook.llm.common import components
from benchbook.llm.words import Hashes, shingles
from tests.llm.conftest import prose


def grams(text):
    words = (text or "").lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(rows, threshold=0.8):
    """Class and number of links of every row by comparing all pairs."""
    sets = [grams(t) for _, t in rows]
    n = len(rows)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * n
    for i in range(n):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if not union or len(sets[i] & sets[j]) >= threshold * union - 1e-9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        best = (doc_id is None, doc_id or 0)
        lowest[find(i)] = min(lowest.get(find(i), best), best)
    return sorted(
        (str(rows[i][0]), str(None if lowest[find(i)][0] else lowest[find(i)][1]), links[i])
        for i in range(n)
    )


def found(df, **how):
    rows = jaccard.near_documents(df, **how).collect()
    return sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in rows), rows


def near_copies(seed, copies, words=120):
    rng = random.Random(seed)
    base = prose(seed, words).split(" ")
    out = []
    for _ in range(copies):
        text = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.fixture(scope="module")
def mixture():
    texts = [prose(i, 100) for i in range(60)]
    for i in range(12):
        texts += near_copies(100 + i, 4)
    texts += near_copies(900, 70)  # one large group
    texts += [texts[3]] * 5 + [texts[70]] * 4
    random.Random(1).shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("chunk", [1024, 16])
def test_against_brute_force(spark, mixture, chunk):
    df = spark.createDataFrame(mixture, "doc_id long, text string").repartition(5)
    got, rows = found(df, chunk=chunk)
    assert got == brute(mixture)
    kept = [r["doc_id"] for r in rows if r["kept"]]
    assert sorted(kept) == sorted({r["class_id"] for r in rows})


def test_odd_tables(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    assert found(odd_docs)[0] == brute(rows)
    assert jaccard.near_documents(no_docs).count() == 0
    assert jaccard.one_of_each(no_docs).count() == 0
    chosen = jaccard.one_of_each(odd_docs)
    assert chosen.columns == odd_docs.columns
    kept = chosen.collect()
    # all different sets stay, but for the one text that is a near copy of another
    assert len(kept) == len({grams(t) for _, t in rows}) - 1
    assert len({grams(r["text"]) for r in kept}) == len(kept)


def test_recall_of_bands():
    bands, rows = jaccard.bands_and_rows(0.8, 0.999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and bands * rows <= 160
    assert jaccard.bands_and_rows(0.5, 0.9)[1] < rows


def test_signatures_estimate_similarity():
    a = prose(5, 400).split(" ")
    b = a[:360] + prose(6, 40).split(" ")
    texts = [" ".join(a), " ".join(b)]
    values, counts = shingles(*Hashes().of(texts), 5)
    keys = jaccard._band_keys(values, counts, 400, 1)
    true = len(grams(texts[0]) & grams(texts[1])) / len(grams(texts[0]) | grams(texts[1]))
    assert np.mean(keys[0] == keys[1]) == pytest.approx(true, abs=0.08)


def test_shingles_are_those_of_each_text():
    texts = ["a b c d e f", "", "x", "a b c d e", "b c d e f g h"]
    values, counts = shingles(*Hashes().of(texts), 5)
    assert counts.tolist() == [2, 0, 1, 1, 3]
    assert values[0] == values[3] and values[1] == values[4] and len(set(values.tolist())) == 5


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 140)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(50)] + [(300, 300)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["root"] for r in components(df).collect()}
    assert got == {x: find(x) for x in root if find(x) != x or x in {find(y) for y in root if y != x}}
    assert components(df.limit(0)).count() == 0
