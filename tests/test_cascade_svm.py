"""The cascade equals one dual solver over all rows, and its optimality conditions hold."""

import numpy as np
import pandas as pd
import pytest

from foldwise.functions.smo import solve
from foldwise.functions.svm import kernel
from foldwise.operators import cascade_svm as CS


def rows(spark, n, classes, seed=1, spread=0.8):
    rnd = np.random.default_rng(seed)
    y = rnd.integers(0, classes, n)
    x = np.stack([np.cos(2.1 * y), np.sin(2.1 * y)], 1) * 2 + spread * rnd.normal(size=(n, 2))
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(n), "features": [list(map(float, v)) for v in x], "label": [f"c{v}" for v in y], "batch": [i % 3 for i in range(n)]}))
    return df, x, y


def test_solver_meets_the_conditions():
    rnd = np.random.default_rng(2)
    x, y = rnd.normal(size=(120, 3)), np.where(rnd.random(120) < 0.5, 1.0, -1.0)
    for args in (("linear", 1.0, 3, 0.0), ("rbf", 0.7, 3, 0.0), ("poly", 0.5, 2, 1.0)):
        a, rho = solve(x, y, 2.0, *args, tol=1e-6)
        m = y * (kernel(x, x, *args) @ (a * y) - rho)
        assert abs(a @ y) < 1e-9 and (a >= 0).all() and (a <= 2.0).all()
        assert (m[a == 0] >= 1 - 1e-4).all() and (m[a == 2.0] <= 1 + 1e-4).all() and np.allclose(m[(a > 0) & (a < 2.0)], 1, atol=1e-4)
    assert solve(x, np.ones(120), 1.0)[1] == -1.0


@pytest.mark.parametrize("kind, classes", [("rbf", 3), ("linear", 2)])
def test_equals_one_solver(spark, kind, classes):
    df, x, y = rows(spark, 500, classes)
    m = CS.cascade_svm(df, kind, C=1.5, gamma=0.5, leaf_rows=70)
    assert m.rounds >= 1 and len(m.machines) == classes * (classes - 1) // 2
    grid = np.random.default_rng(3).normal(size=(300, 2)) * 2
    want = np.zeros((300, len(m.machines)))
    for c, (i, j) in enumerate(m.machines):
        at = np.flatnonzero((y == i) | (y == j))
        s = np.where(y[at] == i, 1.0, -1.0)
        a, rho = solve(x[at], s, 1.5, kind, 0.5, tol=1e-7)
        want[:, c] = kernel(grid, x[at], kind, 0.5) @ (a * s) - rho
    assert np.allclose(m.decisions(grid), want, atol=5e-3)
    k = {r["pair"]: r for r in CS.kkt_report(m, df).collect()}
    assert all(r["violations"] == 0 and abs(r["balance"]) < 1e-6 and r["n_support"] < r["n_rows"] for r in k.values())
    p = m.predict(df).toPandas().set_index("row_id")["predicted"]
    assert np.mean([p[i] == f"c{v}" for i, v in enumerate(y)]) > 0.85


def test_incremental_splits_support_rows(spark):
    df, _, _ = rows(spark, 300, 2, seed=5)
    m, support, steps = CS.cascade_incremental(df, "rbf", 1.0, 0.5, leaf_rows=200)
    got = [tuple(r) for r in steps.orderBy("batch").collect()]
    assert got[0][2] == 0 and all(n == c + w for _, n, c, w in got) and got[1][2] > 0 and got[2][3] > 0
    assert support.count() == got[-1][1] and support.columns == df.columns
    split = {r["row_id"]: r["carried"] for r in CS.support_rows(m, df.where("batch < 2")).collect()}
    assert len(split) == got[-1][1] and sum(split.values()) == got[-1][2]


def test_odd_rows(spark):
    df, _, _ = rows(spark, 60, 2, seed=6)
    odd = spark.createDataFrame([(900, None, "c0", 0), (901, [float("nan"), 0.0], "c1", 0), (902, [0.0, 0.0], None, 0)], df.schema)
    m = CS.cascade_svm(df.unionByName(odd), "rbf", leaf_rows=10)
    assert {r.row_id: r.predicted is None for r in m.predict(odd).collect()} == {900: True, 901: True, 902: False}
    one = CS.cascade_svm(df.where("label = 'c0'"), "rbf")
    assert {r.predicted for r in one.predict(df).collect()} == {"c0"} and one.support.count() == 0
    with pytest.raises(ValueError):
        CS.cascade_svm(df, "nope")
    with pytest.raises(Exception, match="max_rows"):
        CS.cascade_svm(df, "rbf", gamma=500.0, max_rows=20).support.count()
