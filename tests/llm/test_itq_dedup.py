import numpy as np

from foldwise.llm import itq_dedup as D

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.98):
    ok = [r[1] is not None and r[2] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    n = len(rows)
    links = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(a):
            if ok[a] and ok[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], np.float32).astype(float) for k in (a, b))
                links[a, b] = links[b, a] = x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold
    root = list(range(n))
    for _ in range(n):
        new = [min([root[a], *(root[b] for b in np.flatnonzero(links[a]))]) for a in range(n)]
        if new == root:
            break
        root = new
    low = {r: min((rows[a][0] for a in range(n) if root[a] == r and rows[a][0] is not None), default=None) for r in root}
    return [(rows[a][0], int(links[a].sum()), low[root[a]]) for a in range(n)]


def test_recall_and_counts(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 16)
    rng = np.random.default_rng(5)
    rows = []
    for g in range(60):
        base = rng.normal(size=32)
        for _ in range(int(rng.integers(1, 8))):
            rows.append((len(rows), (base + rng.normal(size=32) * rng.uniform(0, 0.22)).astype(np.float32).tolist(), int(g % 2)))
    rows += [(len(rows) + k, [1.0] * 32, 1) for k in range(50)]  # one large group of copies
    got = {r.vec_id: r for r in D.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {i: (n, c) for i, n, c in brute(rows)}
    found, true = sum(r.n_links for r in got.values()), sum(n for n, _ in want.values())
    assert len(got) == len(rows) and all(r.n_links <= want[i][0] for i, r in got.items())
    assert found >= 0.9 * true > 2500
    assert np.mean([r.component_id == want[i][1] for i, r in got.items()]) > 0.9
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1), (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0, 0.0], None),
            (8, [1.0, 0.0], 1), (9, [2.0, 0.0], 1), (10, [1.0, 0.0], 2), (11, [1.0], 1), (9, [2.0, 0.0], 1), (None, [3.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as cid", "'x' as n_links", "'x' as kept")
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in D.near_vectors(df).collect()), key=str)
    assert got == sorted(brute(rows), key=str)
    assert D.near_vectors(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.n_links for r in D.near_vectors(spark.createDataFrame(rows[:7], SCHEMA)).collect()] == [0] * 7
