import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from benchbook.llm import packing
from tests.llm.conftest import prose

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "a b ć x́ <|endoftext|>x I'll 'S \x1c\x0b \x0ca\r\nΣΑΣ ΌΣ İx don't''' l'été é 가 ﻿z 12٣ ™",
    "x" * 3000 + "​ y", "\x85a\x85", "<|ENDOFTEXT|> <|startoftext|>", "a.b,c!!! ,. 'll.\n\t'd", "ÀÉ÷×ß",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_tokenizers(tokenizer):
    texts = ODD + [prose(i, 500) for i in range(5)]
    found = packing.token_ids(texts, PATH, 2)
    for text, ids in zip(texts, found):
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def test_bounded_memory(tokenizer):
    words = packing.WordIds(PATH, limit=50)
    texts = [prose(i, 40) for i in range(6)]
    for text in texts:
        ids = words.of([text], 2)[0].tolist()
        assert ids == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]


def whole(rows, ids_of):
    """Every id of every document in exactly one piece; sequences gapless and not too long."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for doc_id, pieces in docs.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            ids = ids_of[doc_id]
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = np.array(ids[at : at + r["length"]], dtype="<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(part)
            at += r["length"]
        assert at == len(ids_of[doc_id])
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 4096 and all(r["sequence_tokens"] == at for r in pieces)
        padding += 0 if at & (at - 1) == 0 else 4096 - at
    return padding


def test_pack(spark, tokenizer):
    texts = [prose(i, n) for i, n in enumerate([1, 5, 30, 200, 900, 3000, 12_000] * 4)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = packing.pack_documents(df, PATH, buffer_tokens=20_000, step_tokens=16_384).collect()
    ids = {
        i: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)
    }
    assert whole(rows, ids) == 0
    groups = defaultdict(int)
    for r in rows:
        groups[r["step_group"]] += r["length"]
    assert max(groups.values()) <= 16_384 + 2 * 4096
    # short documents are not cut where windows can be filled without
    cut = [r for r in rows if r["doc_tokens"] < 64 and r["length"] < r["doc_tokens"]]
    assert len(cut) <= 6


def test_odd_tables(odd_docs, no_docs, tokenizer):
    rows = packing.pack_documents(odd_docs, PATH).collect()
    total = sum(r["length"] for r in rows)
    texts = [r["text"] or "" for r in odd_docs.select("text").collect()]
    assert total == sum(len(e.ids) + 1 for e in tokenizer.encode_batch(texts, add_special_tokens=False))
    assert any(r["doc_id"] is None for r in rows)
    assert packing.pack_documents(no_docs, PATH).count() == 0
