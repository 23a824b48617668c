import numpy as np
import pytest
from pyspark.sql import functions as F

from benchbook.llm import compression
from benchbook.llm.common import remainder
from benchbook.llm.queries import QUERIES
from benchbook.llm.sampling import labelled_sample, logistic
from tests.llm.conftest import prose


def bad(seed):
    return " ".join(w.upper() + "!!" for w in prose(seed, 120).split())


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, bad(i) if i % 4 == 0 else prose(i, 120), int(i % 4 != 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    return df.select("doc_id", "text"), df.select("doc_id", "quality")


def test_held_out_accuracy(spark, table):
    docs, labels = table
    held_out = remainder("doc_id", 3) == 1
    model = compression.fit_quality(docs, labels, learn=~held_out)
    rows = compression.quality_report(docs, model, held_out).collect()
    right = [r["predicted"] == int(r["doc_id"] % 4 != 0) for r in rows if r["held_out"]]
    assert len(rows) == 400 and len(right) > 100 and np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_the_held_out_fold_do_not_count(spark, table):
    docs, labels = table
    held_out = remainder("doc_id", 3) == 1
    turned = labels.withColumn("quality", F.when(held_out, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert compression.fit_quality(docs, labels, ~held_out) == compression.fit_quality(docs, turned, ~held_out)


def test_sample_is_bounded_and_the_same(spark, table):
    docs, labels = table
    one = labelled_sample(docs, labels, "quality", F.lit(True), 20, 50)
    two = labelled_sample(docs.repartition(7), labels.repartition(5), "quality", F.lit(True), 20, 50)
    assert one == two
    assert len(one[0]) == 40 and max(len(t) for t, _ in one[0]) <= 50
    assert one[1] == {0: 100, 1: 300}


def test_whole_text_counts():
    model = compression.QualityModel(b"", b"", (0.0,) * 7)
    text = prose(1, 5000)
    assert model.sizes([text])[0, 2] == len(text.encode())
    assert b"".join(compression.pieces(text, 500)) == text.encode()


def test_odd_tables(odd_docs, no_docs, labels, no_labels):
    for known in (labels, no_labels):
        model = compression.fit_quality(odd_docs, known)
        scored = compression.score_quality(odd_docs, model)
        assert sorted(scored.columns) == sorted(odd_docs.columns)  # its own score is replaced
        found = [r["score"] for r in scored.collect()]
        assert len(found) == odd_docs.count() and all(0 <= s <= 1 for s in found)
    model = compression.fit_quality(no_docs, no_labels)
    assert compression.score_quality(no_docs, model).count() == 0
    assert model.scores([""])[0] == pytest.approx(0.5)


def test_equal_texts_score_alike(odd_docs, labels):
    model = compression.fit_quality(odd_docs, labels)
    by_text = {}
    for r in compression.score_quality(odd_docs, model).collect():
        assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]


def test_logistic_finds_the_weights():
    rng = np.random.default_rng(0)
    x = np.column_stack([np.ones(4000), rng.normal(size=(4000, 2)) * [1, 30]])
    p = 1 / (1 + np.exp(-(x @ [0.5, 2.0, -0.05])))
    y = (rng.random(4000) < p).astype(float)
    assert logistic(x, y, np.ones(4000)) == pytest.approx([0.5, 2.0, -0.05], rel=0.25)


def test_registered(spark):
    rows = QUERIES["op2_quality_classifier"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and {r["predicted"] for r in rows} <= {0, 1}
