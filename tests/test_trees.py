"""Exact trees and softmax boosting against single-process numpy versions."""

import numpy as np

from foldwise.operators import trees as TR


def table(spark, x, y):
    rows = [(i, [None if np.isnan(v) and i % 2 else float(v) for v in r], None if c is None else f"c{c}") for i, (r, c) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "row_id long, features array<double>, label string")


def points(n=240, classes=3, seed=4):
    rnd = np.random.default_rng(seed)
    x = np.round(rnd.normal(size=(n, 3)) * 3, 1)  # many equal values
    y = (np.digitize(x[:, 0] + 0.5 * x[:, 1], [-1.5, 1.5]) + (rnd.random(n) < 0.1)) % classes
    return x, y


def grow(x, y, k, depth):
    """Brute-force CART: a leaf's counts, or (feature, threshold, left, right)."""
    count = np.bincount(y, minlength=k)
    best = None
    for f in range(x.shape[1]) if depth else ():
        v = np.unique(x[:, f])
        for a, b in zip(v, v[1:]):
            l, r = np.bincount(y[x[:, f] <= a], minlength=k).astype(float), np.bincount(y[x[:, f] > a], minlength=k).astype(float)
            s = round(((l @ l) / l.sum() + (r @ r) / r.sum()) / len(y), 12)
            if best is None or s > best[0]:
                best = (s, f, (a + b) / 2)
    if best is None or best[0] <= round(float(count @ count) / len(y) ** 2, 12) + 1e-12:
        return count
    left = x[:, best[1]] <= best[2]
    return best[1], best[2], grow(x[left], y[left], k, depth - 1), grow(x[~left], y[~left], k, depth - 1)


def flat(t, node=1, level=0, splits=None, leaves=None):
    if isinstance(t, tuple):
        splits.setdefault(level, {})[node] = t[:2]
        flat(t[2], 2 * node, level + 1, splits, leaves)
        flat(t[3], 2 * node + 1, level + 1, splits, leaves)
    else:
        leaves[node] = t.tolist()


def test_exact_tree_equals_brute_force(spark):
    x, y = points()
    got = TR.exact_tree(table(spark, x, y).repartition(3), 3)
    splits, leaves = {}, {}
    flat(grow(x, y, 3, 3), splits=splits, leaves=leaves)
    assert [sorted((n, f, round(t, 9)) for n, (f, t) in lv.items()) for lv in got.splits] == [
        sorted((n, f, round(t, 9)) for n, (f, t) in splits[i].items()) for i in sorted(splits)]
    assert got.leaves == leaves
    said = {r["row_id"]: r["predicted"] for r in got.predict(table(spark, x, y)).collect()}
    assert len(said) == len(x) and sum(said[i] == f"c{c}" for i, c in enumerate(y)) == sum(max(v) for v in leaves.values())


def test_exact_tree_odd_tables(spark):
    x, y = points(60)
    y = y.tolist()
    x[::7, 0] = np.nan
    y[3] = None
    got = TR.exact_tree(table(spark, x, y), 4)
    assert sum(map(sum, got.leaves.values())) == 59 and got.predict(table(spark, x, y)).count() == 60
    one = TR.exact_tree(table(spark, np.ones((5, 2)), [1] * 5), 2)
    assert one.splits == [] and one.leaves == {1: [5]}
    empty = TR.exact_tree(table(spark, np.ones((0, 2)), []), 2)
    assert empty.leaves == {} and empty.predict(table(spark, np.ones((2, 2)), [0, 1])).where("predicted is null").count() == 2


def brute_boost(bins, y, k, rounds, depth, eta, l2=1.0):
    """The same boosting in one process, each split found by trying all."""
    margin, loss = np.zeros((len(y), k)), []
    for _ in range(rounds):
        g, h = TR.slopes(margin, y)
        loss.append(float(np.mean(np.log(np.exp(margin).sum(1)) - margin[np.arange(len(y)), y])))
        step = np.zeros_like(margin)
        for c in range(k):
            def down(at, level):
                gs, hs = g[at, c].sum(), h[at, c].sum()
                step[at, c] = -eta * gs / (hs + l2)
                best = (1e-9,)
                for f in range(bins.shape[1]) if level else ():
                    for b in np.unique(bins[at, f])[:-1]:
                        left = at[bins[at, f] <= b]
                        gl, hl = g[left, c].sum(), h[left, c].sum()
                        if min(hl, hs - hl) >= 1e-3:
                            gain = round(gl**2 / (hl + l2) + (gs - gl) ** 2 / (hs - hl + l2) - gs**2 / (hs + l2), 9)
                            if gain > best[0]:
                                best = (gain, f, b)
                if len(best) > 1:
                    left = bins[at, best[1]] <= best[2]
                    down(at[left], level - 1)
                    down(at[~left], level - 1)
            down(np.arange(len(y)), depth)
        margin += step
    return margin, loss


def test_boosting_equals_brute_force(spark):
    x, y = points(300)
    x[::11, 2] = np.nan
    df = table(spark, x, y).repartition(4)
    m = TR.softmax_boosting(df, rounds=4, eta=0.4, max_depth=2, bins=16)
    bins = TR.binned(x, m.bounds)
    want, loss = brute_boost(bins, y, 3, 4, 2, 0.4)
    assert np.allclose(TR.margins(m.rounds, bins, 3), want, atol=1e-8)
    assert np.allclose(m.loss, loss, atol=1e-9) and all(a > b for a, b in zip(m.loss, m.loss[1:]))
    said = {r["row_id"]: r["predicted"] for r in m.predict(df).collect()}
    assert said == {i: f"c{c}" for i, c in enumerate(np.argmax(want, 1))}
    assert np.mean(np.argmax(want, 1) == y) > 0.75


def test_boosting_odd_tables(spark):
    none = TR.softmax_boosting(table(spark, np.ones((0, 2)), []), 2)
    assert none.rounds == [] and none.predict(table(spark, np.ones((2, 2)), [0, 1])).where("predicted is null").count() == 2
    m = TR.softmax_boosting(table(spark, np.ones((6, 2)), [0, 0, 0, 0, 1, None]), 2)
    assert {r["predicted"] for r in m.predict(table(spark, np.ones((2, 2)), [0, 1])).collect()} == {"c0"}
