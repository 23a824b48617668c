import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from benchbook.llm import rotation as R
from tests.llm.conftest import odd_rows

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def by_hand(doc_id, text, rate=50, spm=80, seed=42):
    """The contract word by word, on a str."""
    text = text or ""
    tokens = TOKEN.findall(text)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(tokens)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def random_text(rng):
    return "".join(
        rng.choice([" ", "\n", "\x0b", "\x1c", "a", "é", "🙂", "<P", "S>", "<", "M", ">", "<P>", "\x85"])
        for _ in range(rng.randrange(12))
    )


@pytest.mark.parametrize("rate, spm", [(50, 80), (100, 0), (100, 100), (0, 50)])
def test_against_strings(rate, spm):
    rng = random.Random(rate + spm)
    for i in range(1500):
        text = random_text(rng)
        buffer = bytearray(text.encode())
        n, form, p, m = R.rearrange(buffer, R.draws(42, i), rate, spm)
        assert (n, form, p, m, buffer.decode()) == by_hand(i, text, rate, spm)
        R.restore(buffer, form)
        assert buffer.decode() == text


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, R.BLOCK - 1, 2 * R.BLOCK, 5 * R.BLOCK + 3])
def test_rotation_and_its_inverse(size):
    rng = random.Random(size)
    data = rng.randbytes(size)
    for cut in {0, size, size // 2, size // 3}:
        buffer = bytearray(b"<" + data + b">")
        R.rotate(buffer, 1, 1 + cut, 1 + size)
        assert buffer == b"<" + data[cut:] + data[:cut] + b">"
        R.rotate(buffer, 1, 1 + size - cut, 1 + size)
        assert buffer == b"<" + data + b">"


def test_tables(spark, odd_docs, no_docs):
    found = R.fill_in_middle(odd_docs, rate=100)
    # columns of the table stay, also those with other operators' names
    assert found.columns == [*odd_docs.columns, "n", "form", "prefix_chars", "middle_chars", "output"]
    again = R.restored(found)
    rows = again.collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        assert r["restored"] == (r["text"] or "")
        want = by_hand(r["doc_id"], r["text"], rate=100)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == want
    assert R.rearranged_digests(no_docs).collect() == []
    assert R.restored(R.fill_in_middle(no_docs)).collect() == []


def test_clashing_names(spark):
    rows = spark.createDataFrame([(1, "a b c", "x", "y")], "doc_id long, text string, form string, n string")
    found = R.fill_in_middle(rows, rate=100)
    assert sorted(found.columns) == sorted({*found.columns})
    assert dict(found.dtypes)["n"] == "bigint"
    same = R.fill_in_middle(rows, rate=100, output="text").collect()[0]
    assert same["text"] == found.collect()[0]["output"]
    assert found.withColumn("form", F.lit(None).cast("string")).transform(R.restored).count() == 1


def test_report(odd_docs):
    for r in R.rearranged_digests(odd_docs).collect():
        assert r["n"] is not None and (r["prefix_chars"] is None) == (r["form"] == "plain")
    texts = {(r["doc_id"], hashlib.sha256((r["text"] or "").encode()).hexdigest())
             for r in odd_docs.select("doc_id", "text").collect()}
    assert {(r["doc_id"], r["restored_sha256"]) for r in R.rearranged_digests(odd_docs).collect()} == texts
