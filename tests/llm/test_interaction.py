import itertools
import math
import random
from collections import Counter
from fractions import Fraction

import pytest

from benchbook.llm import interaction as I


@pytest.mark.parametrize("m", [1, 2, 3, 4, 5, 6])
def test_least_squares_give_shapley_values(m):
    rng = random.Random(m)
    solved = I.solved_normal_equations(m)
    for _ in range(5):
        value = [0, *[rng.randrange(-50, 1000) for _ in range((1 << m) - 1)]]
        shares = [sum(x * v for x, v in zip(row, value)) for row in solved]
        want = [Fraction(0)] * m
        for order in itertools.permutations(range(m)):
            before = 0
            for i in order:
                want[i] += Fraction(value[before | 1 << i] - value[before], math.factorial(m))
                before |= 1 << i
        assert shares == want
    # whole numbers after multiplying by the number of orders
    assert all((x * math.factorial(m)).denominator == 1 for row in solved for x in row)


@pytest.mark.parametrize(
    "text, fails",
    [
        ("", "A"), ("a " * 200, "B"), (" ".join(f"w{i}" for i in range(200)), ""),
        (" ".join(f"w{i}" for i in range(199)), "A"), ("a b a b", "A"), ("a a a", "AB"),
        ("A" + "b" * 49, "A"), ("A" + "b" * 48, "AC"), ("É" * 9, "A"), ("a#", "AD"), ("a|b c", "AD"),
        ("a\x1ca\x1ca", "A"), ("a\x0ba\x0ca", "AB"), ("a\xa0a a", "A"), ("Aa aA", "AC"),
    ],
)
def test_filters(text, fails):
    found = I.text_failures(text)
    assert "".join(c for i, c in enumerate("ABCD") if found >> i & 1) == fails


def simulated(docs, labels):
    """Every order run document by document."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    rows = []
    for doc_id, text, source in docs:
        text = text or ""
        fails = {c for i, c in enumerate("ABCD") if I.text_failures(text) >> i & 1}
        same = [d for d, t, _ in docs if (t or "") == text and d is not None]
        if doc_id is not None and min(same) < doc_id:
            fails.add("E")
        rows.append((source or "", doc_id, fails))
    out = {}
    for part in {r[0] for r in rows}:
        mine, shares = [r for r in rows if r[0] == part], Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = list(mine)
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[2]]
                left = [r for r in left if f not in r[2]]
                shares[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f in r[2] for r in mine) - len(gone),
                    sum(r[2] == {f} for r in mine), sum(r[1] in good for r in gone),
                    sum(r[1] in toxic for r in gone),
                ]
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                out[part, order, step].append(shares[f])
    return out


def test_against_simulation(spark, odd_docs, labels):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]
    marks = [tuple(r) for r in labels.collect()]
    found = I.filter_audit(odd_docs, labels).collect()
    got = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in found}
    assert len(got) == len(found) == 600 * len({s or "" for *_, s in docs})
    assert got == simulated(docs, marks)


def test_copies_across_parts(spark, labels):
    rng = random.Random(4)
    rows = [(rng.randrange(40), rng.choice(["a", "b", None, "", "a A#"]), rng.choice(["x", "y", None, ""]))
            for _ in range(120)] + [(None, "a", "x"), (None, "only here", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = I.filter_audit(docs, labels).collect()
    got = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in found}
    assert got == simulated(rows, [tuple(r) for r in labels.collect()])


def test_empty_tables(spark, no_docs, odd_docs, no_labels):
    assert I.filter_audit(no_docs, no_labels).collect() == []
    found = I.filter_audit(odd_docs, no_labels)
    assert found.agg({"good_lost": "max", "toxic_lost": "max"}).collect()[0][:] == (0, 0)


def test_other_numbers_of_filters(spark):
    counted = spark.createDataFrame(
        [("p", 1, 5, 1, 0), ("p", 3, 2, 0, 1), ("p", 0, 4, 4, 0)],
        "part string, mask int, n long, good long, toxic long",
    )
    found = I.steps_of_orders(I.coalition_removals(counted, 2), "XY").collect()
    assert {tuple(r) for r in found} == {
        ("p", "XY", 1, 4, 7, 0, 5, 1, 1, 12), ("p", "XY", 2, 4, 0, 2, 0, 0, 0, 2),
        ("p", "YX", 1, 9, 2, 0, 0, 0, 1, 2), ("p", "YX", 2, 4, 5, 2, 5, 1, 0, 12),
    }
    with pytest.raises(ValueError):
        I.steps_of_orders(counted, "ABCDEFGH")
