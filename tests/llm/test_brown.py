import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from benchbook.llm import brown
from benchbook.llm.common import remainder

SIZES = {"core_words": 60, "types": 16, "classes": 6, "sweeps": 4, "sent_words": 40}


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def base(rows):
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        words = tokens(t)
        score = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        out.append((str(i), len(words), sum(w in counts for w in words), n, round(score, 6)))
    return sorted(out)


def scored(df, **sizes):
    return brown.score_texts(df, learn=remainder("doc_id", 10) != 0, **(sizes or SIZES))


def plain(rows):
    return sorted(
        (str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
        for r in rows
    )


@pytest.fixture(scope="module")
def language():
    """Two languages of alternating word kinds: classes tell what comes next."""
    rng = random.Random(0)
    rows = []
    for i in range(400):
        kinds = [[f"{lang}{kind}{k}" for k in range(12)] for lang in [rng.choice("ab")] for kind in "nv"]
        rows.append((i, " ".join(rng.choice(kinds[k % 2]).capitalize() for k in range(rng.randrange(60)))))
    return rows


def test_base_and_score(spark, language):
    df = spark.createDataFrame(language, "doc_id long, text string").repartition(4)
    rows = scored(df).collect()
    assert plain(rows) == base(language)
    out = [r for r in rows if held(r["doc_id"]) and r["n_tokens"] > 20]
    gain = sum(r["score"] - r["base_score"] for r in out) / sum(r["n_tokens"] for r in out)
    # knowing language and kind leaves 12 of 48 words: log10 of 4 is 0.6
    assert 0.45 < gain < 0.62


@pytest.mark.parametrize("core", [60, 20])
def test_probabilities_sum_to_one(spark, language, core):
    """Over all known words, the end, and one event a class for words never seen."""
    df = spark.createDataFrame(language, "doc_id long, text string")
    counts = brown.stage(brown.word_counts(df, 16), "counts").cache()
    model, words = brown.fit_classes(df, counts, **{**SIZES, "sent_words": 1000, "core_words": core})
    rows = counts.collect()
    hashes = np.array([r["hash"] for r in rows], dtype=np.int64).view(np.uint64)
    of, sent = model.columns(hashes)
    assert (sent == [r["n"] for r in rows]).all()
    # words that are not exchanged are in the table, with the same counts and classes
    assert {(r["hash"], r["n"], r["class"]) for r in words.collect()} <= {
        (r["hash"], r["n"], c) for r, c in zip(rows, of)
    } and words.count() == max(0, len(rows) - core)
    bracket = 10.0**model.log_bracket
    k = len(bracket)
    for before in range(k):
        total = sum((r["n"] + 0.1) * bracket[before, c] for r, c in zip(rows, of))
        assert total + 0.1 * bracket[before].sum() == pytest.approx(1.0)
    if core < len(rows):
        return
    # a class holds words of one language and kind
    named = {r["hash"]: c for r, c in zip(rows, of)}
    by: dict[int, Counter] = {}
    for word in {w for _, t in language for w in tokens(t) if w}:
        h = np.array([xxhash.xxh64_intdigest(word.encode())], np.uint64).view(np.int64)[0]
        by.setdefault(int(named[int(h)]), Counter())[word[:2]] += 1
    assert sum(c.most_common(1)[0][1] for c in by.values()) >= 44


def test_exchange_never_lowers_the_likelihood():
    rng = np.random.default_rng(1)
    units, k = 40, 5
    pairs = rng.poisson(rng.gamma(0.3, 4, size=(units, units)))

    def likelihood(classes):
        table = np.zeros((k, k))
        np.add.at(table, (classes[:, None], classes[None, :]), pairs)
        return brown._xlogx(table).sum() - brown._xlogx(table.sum(1)).sum() - brown._xlogx(table.sum(0)).sum()

    def contexts(classes):
        out = np.zeros((2, units, k + 1))
        for side, m in ((0, pairs.T), (1, pairs)):
            for u in range(units):
                row = m[u].astype(float)
                out[side, u, k] = row[u]
                row[u] = 0
                out[side, u, :k] = np.bincount(classes, row, k)
        return out

    classes = np.arange(units) % k
    start = likelihood(classes)
    for _ in range(4):
        classes = brown.exchange(contexts(classes), classes, k, np.arange(units))
    assert likelihood(classes) > start


def test_odd_tables(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.select("doc_id", "text").collect()]
    found = scored(odd_docs).collect()
    assert plain(found) == base(rows)
    assert scored(no_docs).count() == 0
    nothing = brown.score_texts(odd_docs, learn=F.lit(False), **SIZES).collect()
    assert len(nothing) == len(rows)
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["score"] <= 1e-9 for r in nothing)


def test_counts_that_are_not_sent_along(spark, language):
    """The join gives rare words what a larger table at hand would."""
    df = spark.createDataFrame(language, "doc_id long, text string")
    few, many = (
        {r["doc_id"]: r["score"] for r in scored(df, **{**SIZES, "core_words": 1, "sent_words": n}).collect()}
        for n in (5, 10_000)
    )
    assert few.keys() == many.keys()
    for i, score in few.items():
        assert score == pytest.approx(many[i], rel=1e-9), i


def test_words_beyond_the_core_get_the_class_of_their_neighbours(spark, language):
    """Of 48 words 20 go through exchange; the others follow them, and it shows held out."""
    df = spark.createDataFrame(language, "doc_id long, text string")

    def gain(**sizes):
        rows = scored(df, **{**SIZES, "core_words": 20, "types": 4, **sizes}).collect()
        out = [r for r in rows if held(r["doc_id"]) and r["n_tokens"] > 20]
        return sum(r["score"] - r["base_score"] for r in out) / sum(r["n_tokens"] for r in out)

    own, spelled = gain(), gain(own_from=1 << 40)
    assert own > spelled + 0.1, (own, spelled)


def test_classes_of_words_against_brute_force(spark, language):
    """Neighbours by class, the class of every word, and the sums by class, in plain Python."""
    k, types = 3, 5
    texts = [tokens(t) for _, t in language[:60]]
    count = Counter(w for t in texts for w in t)
    number = {w: xxhash.xxh64_intdigest(w.encode()) if w else brown.END for w in count}
    core = [None, *sorted(w for w in count if w)[:9]]
    by_hash = sorted(core, key=number.get)
    units = brown.Units(
        np.array([number[w] for w in by_hash], np.uint64),
        np.array([core.index(w) for w in by_hash]), types,
    )
    rng = np.random.default_rng(2)
    classes, gains = rng.integers(0, k, len(core) + types), rng.normal(size=(4 * k, k))
    spelled = {w: zlib.crc32(w.encode()[-3:]) % types for w in count if w}

    def label(w):
        return classes[core.index(w)] if w in core else k + classes[len(core) + spelled[w]]

    around: dict[str, Counter] = {}
    for t in texts:
        for before, w, after in zip([None, *t], t, t[1:]):
            if w not in core:
                around.setdefault(w, Counter()).update([label(before), 2 * k + label(after)])
    of_type = classes[len(core):]
    want, sums = {}, Counter()
    for w, near in around.items():
        gain = sum(n * gains[c] for c, n in near.items())
        own = int(np.argmax(gain)) if count[w] >= 30 else int(of_type[spelled[w]])
        want[np.uint64(number[w]).view(np.int64)] = (count[w], own)
        for c, n in near.items():
            sums[own, int(c)] += n
        sums[own, 4 * k + int(of_type[spelled[w]])] += count[w]

    df = spark.createDataFrame(language[:60], "doc_id long, text string").repartition(3)
    found = brown.word_contexts(df, units, classes, k)
    rows = brown.assign(found, of_type, gains, own_from=30).collect()
    assert {r["hash"]: (r["n"], r["class"]) for r in rows if r["code"] is None} == want
    got = Counter()
    for r in rows:
        if r["code"] is not None:
            got[r["class"], r["code"]] += r["n"]
    assert got == sums


def test_words_of_texts():
    rng = random.Random(1)
    signs = [*" \t\n\x0b\x0c\r\x1c\x85\xa0\u2003AbZ\u00c9\u00e9\u0130\u00df\U0001f6000"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(12))) for _ in range(5000)]
    for part in (texts + ["", "   ", " a", "a "], ["", " "], []):
        found = brown.Spelled.of(pa.array(part, pa.string()), 64)
        plain = [[w.encode() for w in tokens(t)[:-1]] for t in part]
        words = [w for t in plain for w in t]
        assert found.sizes.tolist() == [len(t) for t in plain]
        assert found.hash[found.at].tolist() == [xxhash.xxh64_intdigest(w) for w in words]
        assert found.spelling[found.at].tolist() == [zlib.crc32(w[-3:]) % 64 for w in words]
