import numpy as np
import pytest

from benchbook.llm import projections


def brute(rows, threshold=0.9):
    unit = []
    for _, v in rows:
        x = None if v is None or any(e is None for e in v) else np.array(v, dtype=np.float64)
        ok = x is not None and len(x) and np.isfinite(x).all() and x.any()
        unit.append(x / np.abs(x).max() if ok else None)
    unit = [None if x is None else x / np.linalg.norm(x) for x in unit]
    n = len(rows)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if unit[i] is None or unit[j] is None or len(unit[i]) != len(unit[j]):
                continue
            if unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[find(i)] = min(low.get(find(i), k), k)
    return sorted((str(rows[i][0]), links[i], str(low.get(find(i)))) for i in range(n))


def found(df, **how):
    rows = projections.near_vectors(df, **how).collect()
    for r in rows:
        assert r["kept"] == (r["vec_id"] == r["component_id"])
    return sorted((str(r["vec_id"]), r["n_links"], str(r["component_id"])) for r in rows)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(0)
    x = list(rng.normal(size=(250, 24)))
    for size in (2, 3, 20, 150):
        base = rng.normal(size=24)
        x += [base + 0.15 * rng.normal(size=24) for _ in range(size)]
    x += [x[0]] * 4 + [x[1] * 3.0]
    order = rng.permutation(len(x))
    return [(int(i), [float(e) for e in x[k]]) for i, k in enumerate(order)]


@pytest.mark.parametrize("window, chunk", [(64, 1024), (8, 32)])
def test_against_brute_force(spark, vectors, window, chunk):
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(6)
    assert found(df, window=window, chunk=chunk, passes_at_once=9) == brute(vectors)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
        (7, [1.0, 0.0]), (8, [2.0, 0.0]), (8, [1.0, 0.0]), (None, [1.0, 0.1]), (9, [-1.0, 0.0]),
        (10, [1e300, 0.0]), (11, [1e-300, 0.0]), (12, [1.0, 0.0, 0.0]), (13, [1.0, 0.0, 0.0]),
        (14, [0.0, 1.0]), (14, [-0.0, 1.0]), (None, None),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    extra = df.selectExpr("*", "'x' AS node", "1 AS raw", "2 AS dim", "3 AS copies")
    assert found(extra) == brute(rows)
    assert found(df.limit(0)) == []
    only = df.filter("vec_id < 7")
    assert found(only) == brute(rows[:6])


def test_recall(spark):
    """Pairs right above the threshold are found, far from any window of equal keys."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (y * x).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    pairs = 0.91 * x + np.sqrt(1 - 0.91**2) * y
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([x, pairs]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)
    got = projections.near_vectors(df, window=32).filter("n_links >= 1").count()
    assert got >= 0.99 * 3000


def test_recall_in_a_cone(spark):
    """A third of all vectors lies in a cone, far more of them than a window on each sign prefix."""
    rng = np.random.default_rng(6)

    def beside(x, cosine):
        y = rng.normal(size=x.shape)
        y -= (y * x).sum(axis=1, keepdims=True) * x
        return cosine * x + np.sqrt(1 - cosine**2) * y / np.linalg.norm(y, axis=1, keepdims=True)

    axis = np.zeros((6000, 64))
    axis[:, 0] = 1.0
    cone = beside(axis, 0.85**0.5)
    even = rng.normal(size=(12_000, 64))
    pairs = beside(cone[:300], 0.91)
    x = np.vstack([cone, even, pairs])
    schema = "vec_id long, embedding array<double>"
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], schema).repartition(4)
    rows = {r["vec_id"]: r["component_id"] for r in projections.near_vectors(df, window=16).collect()}
    got = sum(rows[i] == rows[18_000 + i] for i in range(300))
    assert got >= 298


def test_passes():
    assert projections.passes_needed(10, 64, 0.9, 0.999) == 1
    few, many = (projections.passes_needed(n, 64, 0.9, 0.99) for n in (10**4, 10**8))
    assert 1 < few < many


def test_windows_span_tasks_of_few_rows(spark):
    """A border sees as many tasks on both sides as hold a window."""
    assert projections._seams([(0, 9)], 4) == []
    seams = projections._seams([(0, 1), (3, 1), (4, 9)], 4)
    assert seams == [(0, 0, 0, 0), (3, 1, 0, 0), (4, 1, 0, 1), (3, 0, 1, 0), (0, 0, 1, 1), (4, 1, 1, 0)]
    rng = np.random.default_rng(8)
    x = rng.normal(size=(60, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([x, x + 0.1 * rng.normal(size=x.shape)]))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "50")  # about two rows a task
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert found(df, window=30, passes_at_once=2) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_prefixes_are_even_where_vectors_crowd():
    """No prefix of the fitted hashes holds much more than its share, inside a cone or not."""
    rng = np.random.default_rng(9)
    x = rng.normal(size=(30_000, 32))
    x[:10_000] = 0.06 * x[:10_000] + x[0] / np.linalg.norm(x[0])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sample = x[rng.permutation(len(x))[:8192]]
    hashes = projections.fit_hashes(sample, 32, 0, 7)
    assert len(hashes.cuts) == 9
    bits = hashes.bits(x)
    for length in (3, 6, 9):
        counts = np.unique(np.packbits(bits[:, :length], axis=1), axis=0, return_counts=True)[1]
        assert counts.max() <= 2.5 * len(x) / 2**length
    share = hashes.share(bits, np.full(len(x), 6))
    assert share.min() > 0 and abs(share.mean() - 1 / 64) < 0.002
    plain = projections.fit_hashes(sample[:0], 32, 0, 7)
    assert (plain.bits(x) == (x @ plain.planes >= 0)).all()


def test_planned_passes_follow_the_sample():
    rng = np.random.default_rng(10)
    x = rng.normal(size=(4000, 32))
    cone = 0.1 * x + x[0] / np.linalg.norm(x[0])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    cone /= np.linalg.norm(cone, axis=1, keepdims=True)
    plan = lambda sample, rows: projections.plan_passes(sample, rows, 64, 0.9, 0.99, 7)
    assert plan(x, 64) == 1
    assert 1 < plan(x, 4_000) < plan(x, 400_000)
    assert plan(cone, 4_000) > plan(x, 4_000)
