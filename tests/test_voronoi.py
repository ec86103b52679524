"""The pruned kNN join equals brute force on clustered, repeated, odd and empty data."""

import numpy as np
import pandas as pd

from foldwise.operators import neighbors as NB
from foldwise.operators.voronoi import PrunedJoin


def clustered(spark, n=3000, d=6, seed=1, clusters=15):
    rnd = np.random.default_rng(seed)
    centers = 5 * rnd.normal(size=(clusters, d))
    x = centers[rnd.integers(0, clusters, n)] + 0.2 * rnd.normal(size=(n, d))
    x[: n // 3] = x[0]  # one row of a third of the table
    x[n // 3: n // 3 + 200] = np.round(x[n // 3: n // 3 + 200])  # ties
    pdf = pd.DataFrame({"row_id": range(n), "features": [[float(v) for v in r] for r in x], "label": [f"l{i % 5}" for i in range(n)], "fold": [i % 4 for i in range(n)], "member": [i % 2 for i in range(n)]})
    return spark.createDataFrame(pdf).cache(), x


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_equals_one_block(spark):
    df, _ = clustered(spark)
    q, d = df.where("row_id % 5 = 0"), df.where("row_id % 5 <> 0")
    assert rows(NB.knn_join(q, d, 4, block_rows=150)) == rows(NB.knn_join(q, d, 4, block_rows=10_000))


def test_excluded_and_separate_rows(spark):
    df, _ = clustered(spark, 1000, seed=2)
    kw = {"exclude_same": "fold", "within": "member"}
    assert rows(NB.knn_join(df, df, 3, block_rows=100, **kw)) == rows(NB.knn_join(df, df, 3, block_rows=10_000, **kw))


def test_a_scaler_for_each_fold(spark):
    df, _ = clustered(spark, 1000, seed=3)
    kw = {"exclude_same": "fold", "scale_by": NB.fold_minmax(df)}
    assert rows(NB.knn_join(df, df, 3, block_rows=100, **kw)) == rows(NB.knn_join(df, df, 3, block_rows=10_000, **kw))


def test_string_ids_and_numpy(spark):
    df, x = clustered(spark, 800, seed=4)
    named = df.selectExpr("concat('r', lpad(row_id, 5, '0')) AS row_id", "features", "label")
    got = {}
    for q, rank, d, d2, _ in map(tuple, NB.knn_join(named, named, 5, block_rows=64).collect()):
        got.setdefault(q, {})[rank] = (d2, d)
    for i in range(0, 800, 7):
        d2 = np.zeros(800)
        for f in range(x.shape[1]):
            d2 += (x[i, f] - x[:, f]) ** 2
        want = sorted((round(v, 9), f"r{j:05d}") for j, v in enumerate(d2))[:5]
        mine = [got[f"r{i:05d}"][r] for r in range(1, 6)]
        assert [m[1] for m in mine] == [w[1] for w in want] and np.allclose([m[0] for m in mine], [w[0] for w in want])


def test_most_blocks_are_skipped(spark):
    df, _ = clustered(spark, 6000, seed=5, clusters=30)
    r = PrunedJoin(df, df, 5, dim=6, n_data=6000, block_rows=200).report().first()
    assert r.query_rows == 6000 and r.blocks >= 30 and r.visited >= 6000 and r.share < 0.3


def test_missing_features(spark):
    df, _ = clustered(spark, 600, seed=6)
    odd = spark.createDataFrame([(9000, [None] * 6, "l0", 0, 0), (9001, [float("nan")] + [0.0] * 5, "l0", 0, 0), (9002, [float("inf")] * 6, "l0", 0, 0), (9003, None, "l0", 0, 0)], df.schema)
    both = df.unionByName(odd)
    got = rows(NB.knn_join(both, both, 3, block_rows=64))
    assert got == rows(NB.knn_join(df, df, 3, block_rows=64)) and not any(r[0] >= 9000 or r[2] >= 9000 for r in got)
    p = {r.row_id: r.predicted for r in NB.knn_classify(both, odd.unionByName(df.limit(5)), 3, block_rows=64).collect()}
    assert len(p) == 9 and [p[i] for i in range(9000, 9004)] == [None] * 4 and sum(v is not None for v in p.values()) == 5


def test_fewer_rows_than_neighbours(spark):
    df, _ = clustered(spark, 30, seed=7)
    got = rows(NB.knn_join(df, df, 50, block_rows=8))
    assert len(got) == 900 and got == rows(NB.knn_join(df, df, 50, block_rows=100))
    assert NB.knn_join(df, df.where("false"), 2, block_rows=8).count() == 0


def test_queries_of_a_fold_are_searched_together(spark):
    from foldwise.operators import voronoi as V

    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (600, 3)) * [1, 10, 100]
    df = spark.createDataFrame([(i, v.tolist(), f"c{i % 3}", i % 3) for i, v in enumerate(x)], "row_id long, features array<double>, label string, fold int")
    views = {f: (x[np.arange(600) % 3 != f].min(0), x[np.arange(600) % 3 != f].max(0)) for f in range(3)}
    join = V.PrunedJoin(df, df, 4, dim=3, n_data=600, exclude_same="fold", block_rows=32, scale_by=views)
    got = {}
    for r in join.neighbours().orderBy("query_id", "rank").select("query_id", "data_id").collect():
        got.setdefault(r.query_id, []).append(r.data_id)
    for i in range(600):
        lo, hi = views[i % 3]
        f = (x - lo) / (hi - lo)
        d2 = np.round(((f[i] - f) ** 2).sum(1), 9)
        d2[np.arange(600) % 3 == i % 3] = np.inf
        assert got[i] == np.lexsort((np.arange(600), d2))[:4].tolist()
    q = {"f": x[:90], "x": np.arange(90) % 3, "view": np.full(90, 1), "hash": None}
    d = {"f": x[90:], "x": np.arange(90, 600) % 3, "view": np.full(510, 1), "hash": None}
    bar = np.full(90, np.inf)
    once = V._search(q, d, np.arange(90), bar, 4, views, True, (1, V.scaled(q["f"], views[1]), V.scaled(d["f"], views[1])))
    again = V._search(q, d, np.arange(90), bar, 4, views, True)
    assert all((a == b).all() for a, b in zip(once, again, strict=True))
