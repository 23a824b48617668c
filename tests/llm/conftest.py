import random

import pytest

CLASHES = ("score", "spans", "kept", "tokens", "key", "node", "copy", "bands", "row", "hash",
           "weight", "probability", "held_out", "group", "words", "size", "md5")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(
    f"{c} string" for c in CLASHES
)


def prose(seed: int, words: int, vocabulary: int = 400) -> str:
    """Invented prose with lines and sentences."""
    rng = random.Random(seed)
    out = []
    for i in range(words):
        word = f"w{rng.randrange(vocabulary)}x{rng.randrange(3)}"
        out.append(word + rng.choice(["", "", "", "", ".", ",", ".\n"]))
    return " ".join(out).replace("\n ", "\n")


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    texts = [
        None, "", " \t\n ", "one", prose(1, 30), prose(1, 30), prose(2, 60_000), "é́ ſ K 가나다 🙂🙂",
        prose(3, 300), prose(3, 300) + " more", "a\x0bb\x1cc\x85d\xa0e",
    ]
    rows = [
        (i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else None, len(t or ""))
        for i, t in enumerate(texts)
    ]
    rows += [rows[4], rows[4], rows[8]]  # repeated rows
    rows += [(4, prose(9, 40), "de", "src0", 1), (None, prose(5, 50), None, None, None),
             (None, None, None, None, None), (None, None, None, None, None)]
    return [(*r, *["x" if i % 2 else None for i in range(len(CLASHES))]) for r in rows]


@pytest.fixture(scope="session")
def odd_docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd") / "docs")
    spark.createDataFrame(odd_rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    """Labels with nulls, contradictions and ids without a document."""
    rows = [(i, i % 2, (i + 1) % 2) for i in range(8)] + [
        (0, 1, 0), (None, 1, 1), (3, None, None), (999, 0, 1)
    ]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
