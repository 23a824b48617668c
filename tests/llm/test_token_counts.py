import random

import public_tokenizers
import pytest

from benchbook.llm import token_counts as C

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def lengths():
    return C.Lengths(PATH)


def library(lengths, texts):
    return [len(ids) for ids in lengths.model.encode(list(texts))]


ODD = [
    "", " ", "  ", "a", " a", "a ", "a  b", "▁", "▁a▁", "a\nb", "\n", "\t\x00", "www..com", "www.w.",
    "<s></s><unk><0x0A>", "é́ſK", "가나다 🙂🙂", "हिन्दी", "a\xa0b　c", "x1y2 33", "don't", "﻿",
    "a" * 500, "." * 300, " " * 90, "ab. " * 80,
]


def test_odd_texts(lengths):
    for text in ODD:
        assert sum(lengths.of(lengths.cut(text))) == len(lengths.model.encode(text)), repr(text)
        assert "".join(lengths.cut(text)) == (" " + text.replace("▁", " ") if text else "")


def test_random_texts(lengths):
    rng = random.Random(7)
    size = lengths.model.get_piece_size()
    parts = [*ODD[1:-4], *[lengths.model.id_to_piece(rng.randrange(size)) for _ in range(600)]]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(4000)]
    tiers = C.TwoTiers(lengths, {}, limit=200)  # forgets all the time
    found = [n for at in range(0, 4000, 50) for n in tiers.count(texts[at : at + 50])]
    assert found == library(lengths, texts)
    assert len(tiers.known) <= 200 + 50 * 25 * 25


def test_no_merge_crosses_a_cut(lengths):
    """Every pair of neighbours in a piece stays together wherever it stands."""
    pieces = C.pieces_of(lengths.model)
    pairs = sorted({(a, b) for p in pieces for a, b in zip(p, p[1:])})
    for a, b in pairs:
        for text in (f"{a}{b}", f"x {a}{b}", f"{a}{b}."):
            plain = text.replace("▁", " ")
            cut = lengths.cut(text)
            ends, at = set(), 0
            for word in cut:
                at += len(word)
                ends.add(at)
            assert plain.index((a + b).replace("▁", " ")) + 2 not in ends  # one space is put before


def test_coarser_patterns():
    assert C.safe_pattern(["a▁b"]).findall("a b c") == ["a b c"]
    assert C.safe_pattern([".a", "▁b"]).findall(" x .a  b ") == [" x", " .a", "  b", " "]
    assert C.safe_pattern(["ab"]).findall(" ab, c") == [" ab", ",", " c"]
    assert C.safe_pattern(["w."]).findall(" w.. v..") == [" w..", " v", ".."]


def test_sketch_keeps_the_frequent():
    rng = random.Random(3)
    items = [str(min(int(rng.paretovariate(1)), 10**6)) for _ in range(60_000)]
    sketches = [C.Sketch(50) for _ in range(4)]
    for at in range(0, len(items), 100):
        sketches[at // 100 % 4].add(items[at : at + 100])
    whole = C.Sketch(50)
    for s in sketches:
        s.shrink()
        assert len(s.counts) <= 50
        whole.merge(list(s.counts), list(s.counts.values()))
    whole.shrink()
    for item in {i for i in items if items.count(i) > len(items) / 50}:
        assert item in whole.counts


def test_tables(spark, lengths, odd_docs, no_docs):
    rows = C.count_tokens(odd_docs, PATH, n_tokens="tokens").collect()
    assert [r["tokens"] for r in rows] == library(lengths, [r["text"] or "" for r in rows])
    assert len(rows) == odd_docs.count()
    assert C.count_tokens(no_docs, PATH).collect() == []
    report = C.token_report(odd_docs, PATH, limit=10)
    assert report.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    texts = [r["text"] or "" for r in odd_docs.collect()]
    want = sorted((len(t.encode()), n, n > 10) for t, n in zip(texts, library(lengths, texts)))
    assert sorted(tuple(r)[1:] for r in report.collect()) == want


def test_first_tier_only_decides_speed(spark, lengths):
    texts = ["one two, three", "two  two", None, "four."]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    want = library(lengths, [t or "" for t in texts])
    for frequent in ([], [" two"], C.frequent_pre_tokens(rows, PATH, size=3)):
        found = C.count_tokens(rows, PATH, frequent=frequent, limit=1).orderBy("doc_id").collect()
        assert [r["n_tokens"] for r in found] == want
    assert C.frequent_pre_tokens(rows, PATH)[0] == " two"
