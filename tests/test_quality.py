import random

from pyspark.sql import functions as F

from benchbook.functions import quality


def _score(c):
    return quality.quality_score(c, F.lower(c))


def test_rounding_is_exact(values):
    pick = random.Random(5)
    scores = [pick.random() for _ in range(2000)]
    scores += [n / d * 0.5 + k / 10 * 0.5 for d in (200, 1000, 2000) for n in range(0, d, 7) for k in range(11)]
    scores += [0.0625, 0.0005, 0.1875, 0.3, 0.9995, 1.0, 0.0]
    assert values(quality.round3, scores, "double") == [round(s, 3) for s in scores]


def test_score(values):
    words = ["word"] * 99
    texts = [
        " ".join(words),
        " ".join(words + ["end"]),
        "\n".join(words + ["Court", "court", "held"]),
        "\xa0".join(words + ["a"]) + " ",
        "",
    ]

    def expected(text):
        if len(text.split()) < 100:
            return 0.0
        hits = sum(w in text.lower() for w in ("court", "held"))
        return round(sum(c.isalpha() for c in text) / len(text) * 0.5 + hits / 10 * 0.5, 3)

    assert values(_score, texts) == [expected(t) for t in texts]
    assert values(quality.word_count, texts) == [len(t.split()) for t in texts]
    assert values(quality.alpha_ratio, ["aé1 ß", "", "१अ"]) == [0.6, 0.0, 0.5]


def test_gate_keeps_its_limit(values):
    assert values(quality.passes_gate, [0.25, 0.249, 1.0], "double") == [True, False, True]


def test_hash(values):
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert values(quality.content_hash, ["", None]) == [empty, None]
