import itertools

import numpy as np
import pytest

from benchbook.llm import crf
from benchbook.llm.common import remainder
from benchbook.llm.queries import QUERIES
from tests.llm.conftest import prose

INSULTS = ("dolt", "knave", "oaf")


def text(i):
    words = prose(i, 150).split(" ")
    if i % 5 == 0:
        for k in range(4):
            words.insert(20 + 25 * k, INSULTS[(i + k) % 3])
    return " ".join(words)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, text(i), int(i % 5 == 0)) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


@pytest.fixture(scope="module")
def model(docs):
    return crf.fit_toxicity(*docs, learn=remainder("doc_id", 5) != 0)


def test_held_out(docs, model):
    held_out = remainder("doc_id", 5) == 0
    rows = crf.toxicity_report(docs[0], model, held_out).collect()
    right = [r["predicted"] == int(r["doc_id"] % 5 == 0) for r in rows if r["held_out"]]
    assert len(rows) == 500 and len(right) > 60 and np.mean(right) > 0.95
    for r in rows:
        body = text(r["doc_id"])
        found = [w for s in r["spans"] for w in body[s["start"] : s["end"]].split()]
        if r["doc_id"] % 5 == 0:
            assert len([w for w in found if w.strip(".,") in INSULTS]) >= 3
        else:
            assert not found


def test_marginals_equal_the_sum_over_all_taggings():
    rng = np.random.default_rng(3)
    lengths = np.array([1, 4, 6, 2])
    starts = np.cumsum(lengths) - lengths
    odds, stay, leave = np.exp(rng.normal(size=lengths.sum())), 1.7, 0.4
    toxic, both, left = crf.forward_backward(odds, starts, lengths, stay, leave)
    at_pairs = 0
    for a, n in zip(starts, lengths):
        total, own, pair = 0.0, np.zeros(n), np.zeros((2, n - 1))
        for tags in itertools.product((0, 1), repeat=int(n)):
            p = np.prod([odds[a + i] for i in range(n) if tags[i]])
            for u, v in zip(tags, tags[1:]):
                p *= (stay if v else leave) if u else 1
            total += p
            own += p * np.array(tags)
            pair[0] += [p * (u and v) for u, v in zip(tags, tags[1:])]
            pair[1] += [p * (u and not v) for u, v in zip(tags, tags[1:])]
        assert toxic[a : a + n] == pytest.approx(own / total)
        assert both[at_pairs : at_pairs + n - 1] == pytest.approx(pair[0] / total)
        assert left[at_pairs : at_pairs + n - 1] == pytest.approx(pair[1] / total)
        at_pairs += n - 1


def test_chains_cover_all_tokens():
    ends = np.zeros(300, dtype=bool)
    ends[[3, 10, 250]] = True
    starts, lengths = crf.chains(ends, np.array([5, 0, 100, 195]))
    assert lengths.sum() == 300 and lengths.max() <= crf.CHAIN and (lengths > 0).all()
    assert starts.tolist() == (np.cumsum(lengths) - lengths).tolist()
    assert {0, 4, 5, 11, 105} <= set(starts.tolist())


def test_scores_do_not_depend_on_the_batch(model):
    texts = [text(i) for i in (0, 5, 7)] + ["", prose(4, 3000)]
    tagger = model.tagger()
    together, sizes = tagger.marginals(texts)
    alone = [model.tagger().marginals([t])[0] for t in texts]
    assert np.concatenate(alone) == pytest.approx(together)
    small = crf.Tagger(model, limit=20)
    assert np.concatenate([small.marginals([t])[0] for t in texts]) == pytest.approx(together)


def test_odd_tables(odd_docs, no_docs, labels, no_labels):
    for known in (labels, no_labels):
        found = crf.fit_toxicity(odd_docs, known)
        scored = crf.score_toxicity(odd_docs, found)
        assert sorted(scored.columns) == sorted(odd_docs.columns)
        rows = scored.collect()
        assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["spans"] == [] for r in rows if not r["text"])
    assert crf.score_toxicity(no_docs, crf.fit_toxicity(no_docs, no_labels)).count() == 0


def test_registered(spark):
    rows = QUERIES["op9_toxicity"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(0 <= r["score"] <= 1 for r in rows)
