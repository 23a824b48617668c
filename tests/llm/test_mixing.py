import numpy as np
import pytest
from pyspark.sql import functions as F

from benchbook.llm import mixing


def margins(cells, values, axis):
    out = {}
    for cell, v in zip(cells, values):
        out[cell[axis]] = out.get(cell[axis], 0) + v
    return {k: v / sum(values) for k, v in out.items()}


CELLS = [(s, l, t) for s in "abc" for l in "xy" for t in "pq"]
TARGETS = [{"a": 0.2, "b": 0.3, "c": 0.5}, {"x": 0.6, "y": 0.4}, {"p": 0.7, "q": 0.3}]


def test_raking_meets_all_marginals():
    tokens = np.random.default_rng(0).integers(100, 10_000, len(CELLS)).astype(float)
    found = mixing.rake(CELLS, tokens, TARGETS, 0.1 * tokens.sum())
    assert found.error < 1e-6 and (found.expected <= tokens).all()
    for axis, want in enumerate(TARGETS):
        assert margins(CELLS, found.expected, axis) == pytest.approx(want, abs=1e-5)


def test_raking_equals_plain_fitting_by_hand():
    """Without full cells: the product form, which keeps odds ratios."""
    cells = [("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")]
    tokens = np.array([40.0, 10.0, 20.0, 30.0])
    want = tokens * 0.1
    for _ in range(2000):
        for axis, share in ((0, (0.5, 0.5)), (1, (0.3, 0.7))):
            for side, name in enumerate(("ab", "xy")[axis]):
                at = [i for i, c in enumerate(cells) if c[axis] == name]
                want[at] *= share[side] * 10 / want[at].sum()
    found = mixing.rake(cells, tokens, [{"a": 0.5, "b": 0.5}, {"x": 0.3, "y": 0.7}], 10.0)
    assert found.expected == pytest.approx(want, rel=1e-4)
    odds = lambda v: v[0] * v[3] / v[1] / v[2]
    assert odds(found.expected) == pytest.approx(odds(tokens), rel=1e-4)


def test_largest_total_is_feasible_and_not_beaten():
    tokens = np.random.default_rng(1).integers(100, 10_000, len(CELLS)).astype(float)
    total, found = mixing.largest_total(CELLS, tokens, TARGETS, 0.002)
    assert 0 < total < tokens.sum() and found.error <= 0.002
    assert mixing.rake(CELLS, tokens, TARGETS, 1.05 * total).error > 0.002
    own = [margins(CELLS, tokens, axis) for axis in range(3)]
    assert mixing.largest_total(CELLS, tokens, own, 0.002)[0] == tokens.sum()


def test_shares():
    assert mixing.shares_of({"a": 1, "b": 1, "zz": 5}, {"a": 9.0, "b": 1.0}) == {"a": 0.5, "b": 0.5}
    found = mixing.shares_of({"a": 0.5}, {"a": 60.0, mixing.OTHER: 40.0})
    assert found == pytest.approx({"a": 0.6, mixing.OTHER: 0.4})
    assert mixing.shares_of({"b": 1.0}, {"a": 3.0}) == {"a": 1.0}


def test_sample(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("text "), "id").alias("text"),
        F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 3 == 1, "mid").otherwise(None).alias("source"),
        F.when(F.col("id") % 5 < 3, "en").otherwise("de").alias("lang"),
    )
    targets = [(F.col("source"), {"big": 0.2, "mid": 0.5}), (F.col("lang"), {"en": 0.5, "de": 0.5})]
    found = mixing.mix_documents(df, targets, F.lit(10) + F.col("doc_id") % 7)
    rows = found.collect()
    kept = [r for r in rows if r["kept"]]
    total = sum(r["tokens"] for r in kept)
    # what is not named keeps its share, a third
    for column, want in (("source", {"big": 2 / 3 * 2 / 7, "mid": 2 / 3 * 5 / 7, None: 1 / 3}),
                         ("lang", {"en": 0.5, "de": 0.5})):
        for value, share in want.items():
            got = sum(r["tokens"] for r in kept if r[column] == value) / total
            assert got == pytest.approx(share, abs=0.02)
    expected = sum(r["tokens"] * r["probability"] for r in rows)
    assert total == pytest.approx(expected, rel=0.03)
    again = mixing.mix_documents(df.repartition(9), targets, F.lit(10) + F.col("doc_id") % 7)
    assert sorted(r["doc_id"] for r in again.filter("kept").collect()) == sorted(r["doc_id"] for r in kept)


def test_odd_tables(odd_docs, no_docs):
    found = mixing.standard_mix(odd_docs)
    rows = found.collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r["probability"] <= 1 and r["tokens"] >= 0 for r in rows)
    counted = {(r["source"], r["lang"]) for r in rows if r["tokens"]}
    assert all(r["kept"] for r in rows if (r["source"], r["lang"]) not in counted)
    by_row = {}
    for r in rows:  # repeated rows share their fate
        assert by_row.setdefault((r["doc_id"], r["text"]), r["kept"]) == r["kept"]
    chosen = mixing.sampled(odd_docs)
    assert chosen.columns == odd_docs.columns and chosen.count() == sum(r["kept"] for r in rows)
    assert mixing.standard_mix(no_docs).count() == 0


def test_topics(spark):
    texts = [None, "a b", "w " * 100, "w\n" * 100, "w " * 1000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    topic = mixing.layout_topic("text", mixing.word_count("text"))
    assert [r[0] for r in df.select(topic).collect()] == ["empty", "snippet", "note", "list", "article"]


def test_marginals_that_contradict_each_other():
    """The most that can be kept at the smallest error, not a constant share."""
    cells, targets = [("a", "x"), ("b", "y")], [{"a": 0.5, "b": 0.5}, {"x": 0.8, "y": 0.2}]
    for tokens in ([500.0, 500.0], [900.0, 100.0], [100.0, 900.0]):
        tokens = np.array(tokens)
        total, found = mixing.largest_total(cells, tokens, targets, 0.002)
        # shares p and 1 - p: the larger of |p - 0.5| and |p - 0.8| is 0.15 at best
        assert 0.14 < found.error <= 0.153
        assert total == pytest.approx(min(tokens[0] / 0.65, tokens[1] / 0.35), rel=0.02)


def test_error_is_told_and_names_may_clash(spark):
    rows = [(i, f"text {i}", "a" if i % 2 else "b") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").select(
        "*", F.lit("x").alias("_tokens"), F.lit("y").alias("_cell0"), F.lit(1).alias("_cell1"),
        F.lit(1).alias("n"), F.lit(1).alias("_n"), F.lit(2).alias("mix_error"), F.lit("z").alias("a.b"),
    )
    lang = F.when(F.col("source") == "a", "x").otherwise("y")
    found = mixing.mix_documents(
        df, [(F.col("source"), {"a": 0.5, "b": 0.5}), (lang, {"x": 0.8, "y": 0.2})], F.lit(10)
    ).collect()
    assert len(found) == 400 and {r["mix_error"] for r in found} == {found[0]["mix_error"]}
    assert 0.14 < found[0]["mix_error"] < 0.16
    assert {(r["_tokens"], r["_cell0"], r["a.b"]) for r in found} == {("x", "y", "z")}
    fits = mixing.mix_documents(df, [(F.col("source"), {"a": 0.6, "b": 0.4})], F.lit(10)).collect()
    assert fits[0]["mix_error"] <= 0.002
