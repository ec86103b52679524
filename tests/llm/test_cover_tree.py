import math

import numpy as np
import pytest

from foldwise.llm import cover_tree as ct


def table(spark, rows, extra=()):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    return df


def brute(rows, every=100):
    live = []
    for vec_id, v, label in rows:
        if vec_id is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(256 * float(np.float32(x))) for x in v]
        live.append((vec_id, v, math.fmod(label + 1, 10) if vec_id % 7 == 0 else label))
    cand = list({(i, tuple(v), y): (i, v, y) for i, v, y in live}.values())
    out = []
    for a, q, y in live:
        if a % every:
            continue
        score = lambda v: sum(p * r for p, r in zip(q, v))
        near = sorted(((-score(v), i) for i, v, z in cand if z == y and i != a))[:5]
        for s, p in near:
            s = -s
            far = sorted((-score(v), i) for i, v, z in cand if z != y and 80 * s <= 100 * score(v) <= 100 * s)[:5]
            out += [(a, p, r, i, s, -t) for r, (t, i) in enumerate(far, 1)]
    return sorted(out)


def mined(df, **kw):
    got = ct.mine_hard_negatives(ct.prepared(df), **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def clustered(seed, n, d, clusters=12, scale=1.0):
    rnd = np.random.default_rng(seed)
    centers = rnd.normal(size=(clusters, d))
    v = centers[rnd.integers(0, clusters, n)] + 0.15 * rnd.normal(size=(n, d))
    return [(int(i), [float(x) for x in scale * v[i]], int(rnd.integers(0, 10))) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(ct, "SHARD_ROWS", 150)  # several shards, blocks and pages
    monkeypatch.setattr(ct, "PAGE", 3)
    monkeypatch.setattr(ct, "BLOCK", 4)
    rows = clustered(seed, 1500, 8)
    assert mined(table(spark, rows, extra=("vec", "dim", "cell", "part", "key", "n", "rank")), every=100) == brute(rows)


def test_odd_rows(spark):
    rows = clustered(3, 600, 5)
    rows += [(700, None, 1), (800, [1.0] * 5, None), (None, [1.0] * 5, 1), (900, [1.0, None, 1.0, 1.0, 1.0], 1), (1000, [float("nan")] * 5, 2), (1100, [float("inf")] * 5, 2)]
    rows += [(1200, [], 3), (1300, [0.0] * 5, 4), (1400, [0.5, 0.25], 3), (1500, [0.1] * 9, 3), (1600, [-1.0] * 5, 9)]
    rows += [(1700, rows[0][1], 5)] * 3 + [(1701, rows[0][1], 5), (1701, rows[1][1], 5), (1701, rows[0][1], 6)]
    rows += [(2000 + i, [1.0, 0.0, 0.0, 0.0, 0.0], i % 2) for i in range(600)]  # one vector of half the rows
    got = mined(table(spark, rows))
    assert got == brute(rows)
    assert any(a == 1700 for a, *_ in got) and not any(a in (700, 800, 900, 1000, 1100) for a, *_ in got)


def test_large_values_stay_exact(spark):
    rows = [(i, [float(np.float32(1e5 + 37 * i)), float(np.float32(3e5 - 11 * i)), 2.5], i % 3) for i in range(300)]
    assert mined(table(spark, rows)) == brute(rows)
    with pytest.raises(ValueError):
        mined(table(spark, [(0, [1e9, 1e9], 1), (1, [1.0, 1.0], 2)]))


def test_empty_and_lonely(spark):
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(0, [1.0], 1)])) == []
    assert mined(table(spark, [(0, [1.0], 1), (1, [1.0], 1)])) == []


def test_tree_bounds_hold_and_skip_leaves():
    rnd = np.random.default_rng(4)
    centers = rnd.normal(size=(30, 16)) * 256
    x = np.rint(centers[rnd.integers(0, 30, 4000)] + 8 * rnd.normal(size=(4000, 16))).astype(np.int32)
    top = float(ct._norms(x.astype(float)).max())
    big = ct._augmented(x.astype(float), top)
    order, nodes, radii = ct.build_tree(big)
    assert sorted(order) == list(range(4000))
    for (c, first, n, lo, hi), r in zip(nodes, radii):
        assert np.sqrt(ct._norms(big[order[lo:hi]] - big[order[c]])).max() <= r + 1e-9
        if n:
            kids = nodes[first:first + n]
            assert kids[0][3] == lo and kids[-1][4] == hi and (kids[1:, 3] == kids[:-1, 4]).all()
            assert kids[0][0] == c  # nesting
    ids = np.arange(4000)
    t = ct.Tree({"n": 4000, "dim": 16, "ids": ids[order].tobytes(), "labels": np.zeros(4000, np.int64).tobytes(), "vecs": x[order].tobytes(), "nodes": nodes.tobytes(), "radii": radii.tobytes()}, top)
    q = x[:3]
    a = ct.Anchors({"m": 3, "dim": 16, "ids": ids[:3].tobytes(), "keys": ids[:3].tobytes(), "labels": np.zeros(3, np.int64).tobytes(), "vecs": q.tobytes(),
                    "lo": np.full((3, 1), ct.NONE).tobytes(), "hi": np.full((3, 1), ct.FAR).tobytes()}, True, 5, top)
    leaves = a.descend(t)
    want = [sorted((-int(s), j) for j, s in enumerate(x.astype(np.int64) @ v.astype(np.int64)) if j != i)[:5] for i, v in enumerate(q)]
    assert [[(-int(s), int(j)) for s, j in zip(a.score[i, 0], a.vec[i, 0])] for i in range(3)] == want
    assert leaves < (nodes[:, 2] == 0).sum() / 3
