import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from benchbook.llm import compression, mixing
from benchbook.llm.common import remainder
from tests.llm.test_jaccard import brute, near_copies
from tests.llm.test_secret_scan import base_spans
from tests.llm.conftest import prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    texts = []
    for i in range(240):
        if i % 6 == 0:
            texts.append(" ".join(w.upper() + "!!" for w in prose(i, 120).split()))
        elif i % 7 == 0:
            texts.append(near_copies(i // 60, 1)[0])
        else:
            texts.append(prose(i, 150) + (" password=abc123xyz" if i % 10 == 1 else ""))
    rows = [(i, t, "en" if i % 3 else "de", f"src{i % 4}", len(t), "x") for i, t in enumerate(texts)]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, score string"
    ).repartition(3).write.parquet(str(path / "documents.parquet"))
    labels = [(i, int(i % 6 != 0), 0) for i in range(0, 240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        str(path / "labels.parquet")
    )
    return str(path)


def staged(spark, folder, tmp_path):
    """Documents before and after every stage, as the driver runs them."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        step(spark, docs, folder).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        out.append(docs)
    return out


def test_stages(spark, folder, tmp_path):
    start, good, single, clean, mixed, packed = staged(spark, folder, tmp_path)
    for df in (good, single, clean, mixed):
        assert df.columns == start.columns
    ids = [r["doc_id"] for r in good.collect()]
    assert len([i for i in ids if i % 6 == 0]) <= 2 and len(ids) >= 195
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = compression.fit_quality(start, labels, learn=remainder("doc_id", 3) != 1)
    want = {r["doc_id"] for r in compression.score_quality(start, model).filter("score >= 0.5").collect()}
    assert set(ids) == want

    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    classes = {int(c) for _, c, _ in brute(rows)}
    assert {r["doc_id"] for r in single.collect()} == classes and single.count() == len(classes)

    before = {r["doc_id"]: r for r in single.collect()}
    after = {r["doc_id"]: r for r in clean.collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not base_spans(r["text"]) and r["n_chars"] == len(r["text"])
        assert r["text"] == before[i]["text"] or base_spans(before[i]["text"])

    fate = {r["doc_id"]: r["kept"] for r in mixing.standard_mix(clean).collect()}
    assert {r["doc_id"] for r in mixed.collect()} == {i for i, kept in fate.items() if kept}
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in mixed.collect()}
    whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert whole.filter("n != all").count() == 0


def test_run_gives_the_last_stage(spark, folder, tmp_path):
    last = staged(spark, folder, tmp_path)[-1]
    found = corpus_pipeline.run(spark, folder)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select("doc_id", "doc_tokens").distinct().collect())) == sorted(
        map(tuple, last.select("doc_id", "doc_tokens").distinct().collect())
    )
    assert set(key) <= set(found.columns)


def test_odd_tables(spark, odd_docs, no_docs, labels, tmp_path):
    for name, docs in (("odd", odd_docs), ("empty", no_docs)):
        path = tmp_path / name
        docs.write.parquet(str(path / "documents.parquet"))
        labels.write.parquet(str(path / "labels.parquet"))
        results = staged(spark, str(path), path)
        assert all(df.columns == docs.columns for df in results[:-1])
        assert (results[-1].count() > 0) == (name == "odd")
