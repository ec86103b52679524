"""Trees grown on Spark: exact CART and multi-class gradient boosting.

``exact_tree`` (M2) searches all distinct values of all features. A level is one pass: rows become
(node, feature, value) with class counts, combined before the shuffle, and bucketed running sums give the
class counts left of every value, so no task sorts a whole feature.

``softmax_boosting`` (M13) fits one tree a class and round to the gradients and curvatures of the softmax
loss. Features are cut into bins once; a level of all trees of a round is one pass in which each task adds up
(class, node, feature, bin) histograms, which Spark sums. Rows, their bins and classes are stored once and
never rewritten: margins follow from the trees, which are small parameters.

In both, a missing value (NULL or NaN) goes right and takes no part in the choice of a split (in boosting it has a
bin of its own, the last); rows without a class aren't trained on. Of equal splits the one with the smallest feature, then the smallest value, wins.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.functions.prep import class_list
from foldwise.operators.ranking import running_sum
from foldwise.session import cut_lineage

#: most leaves of a tree (its splits are a broadcast table) and most numbers of a task's histograms
MAX_LEAVES = 4096
MAX_CELLS = 1 << 25


def _class_index(classes: list, label: str) -> Column:
    return F.array_position(F.array(*[F.lit(str(c)) for c in classes]).cast("array<string>"), F.col(label).cast("string")).cast("int") - 1


def _class_of(index: Column, classes: list) -> Column:
    return F.get(F.array(*[F.lit(str(c)) for c in classes]).cast("array<string>"), index.cast("int"))


# ------------------------------------------------------------------ exact CART
@dataclass
class ExactTree:
    """``splits``: per level, node -> (feature, threshold); ``leaves``: node -> class counts. The root is node 1, children are 2n and 2n + 1."""
    classes: list
    splits: list[dict[int, tuple[int, float]]] = field(default_factory=list)
    leaves: dict[int, list[int]] = field(default_factory=dict)

    def routed(self, df: DataFrame) -> DataFrame:
        df = df.withColumn("node", F.lit(1).cast("long"))
        for level in self.splits:
            table = df.sparkSession.createDataFrame([(n, f, t) for n, (f, t) in level.items()], "node long, _f int, _t double")
            down = F.when(F.get(F.col("features"), F.col("_f")) <= F.col("_t"), F.col("node") * 2).otherwise(F.col("node") * 2 + 1)
            df = df.join(F.broadcast(table), "node", "left").withColumn("node", F.when(F.col("_f").isNull(), F.col("node")).otherwise(down)).drop("_f", "_t")
        return df

    def predict(self, df: DataFrame, id_col: str = "row_id") -> DataFrame:
        """The most frequent class of a row's leaf, the first of equally frequent ones."""
        best = df.sparkSession.createDataFrame([(n, int(np.argmax(c))) for n, c in self.leaves.items()], "node long, _y int")
        rows = self.routed(df.select(id_col, "features")).join(F.broadcast(best), "node", "left")
        return rows.select(id_col, _class_of(F.col("_y"), self.classes).alias("predicted"))


def split_table(rows: DataFrame, d: int, k: int) -> DataFrame:
    """The best split of each node: node, feature, value (the largest one on the left), above (the next one),
    n_left, n_right, score and base (sums of squared class shares, weighted by size, after and before).
    ``rows``: node, features, y (class number)."""
    ns, bs = [f"_n{i}" for i in range(k)], [f"_b{i}" for i in range(k)]
    cells = rows.select("node", "y", F.posexplode("features").alias("f", "x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    counts = cells.groupBy((F.col("node") * d + F.col("f")).alias("grp"), "x").agg(*[F.count_if(F.col("y") == i).alias(n) for i, n in enumerate(ns)])
    counts = cut_lineage(counts)
    totals = counts.groupBy("grp").agg(*[F.sum(n).alias(f"_t{i}") for i, n in enumerate(ns)])
    run = running_sum(counts, ["grp"], "x", ns, bs).join(F.broadcast(totals), "grp")  # nodes x features rows
    left = [(F.col(b) + F.col(n)).cast("double") for b, n in zip(bs, ns)]
    all_ = [F.col(f"_t{i}").cast("double") for i in range(k)]
    nl, nt = sum(left[1:], left[0]), sum(all_[1:], all_[0])
    nr = nt - nl
    right = [t - x for t, x in zip(all_, left)]
    squares = lambda cols: sum((c * c for c in cols[1:]), cols[0] * cols[0])
    scored = run.withColumn("nl", nl).withColumn("nr", nr).where("nr > 0").select(
        F.floor(F.col("grp") / d).alias("node"), (F.col("grp") % d).cast("int").alias("f"), "x", F.col("nl").cast("long").alias("nl"), F.col("nr").cast("long").alias("nr"),
        F.round((squares(left) / F.col("nl") + squares(right) / F.col("nr")) / nt, 12).alias("score"), F.round(squares(all_) / (nt * nt), 12).alias("base"))
    best = scored.groupBy("node").agg(F.max(F.struct("score", (-F.col("f")).alias("f"), (-F.col("x")).alias("x"), "nl", "nr", "base")).alias("b"))
    best = best.select("node", (-F.col("b.f")).alias("feature"), (-F.col("b.x")).alias("value"), F.col("b.nl").alias("n_left"), F.col("b.nr").alias("n_right"),
                       F.col("b.score").alias("score"), F.col("b.base").alias("base"))
    best = cut_lineage(best)
    after = counts.join(F.broadcast(best.select((F.col("node") * d + F.col("feature")).alias("grp"), F.col("value"))), "grp").where("x > value")
    after = after.groupBy("grp").agg(F.min("x").alias("above"))
    return best.join(F.broadcast(after), F.col("grp") == F.col("node") * d + F.col("feature")).drop("grp")


def exact_tree(df: DataFrame, max_depth: int, classes: list | None = None, label: str = "label") -> ExactTree:
    """M2: Gini CART over all distinct values, thresholds half-way between neighbours. A node is split while that lowers the impurity."""
    if 2 ** max_depth > MAX_LEAVES:
        raise ValueError(f"a tree has at most {MAX_LEAVES} leaves")
    classes = classes or class_list(df.where(F.col(label).isNotNull()), label)
    tree = ExactTree(classes)
    rows = df.select("features", _class_index(classes, label).alias("y")).where("y >= 0")
    first = rows.first()
    if first is None:
        return tree
    rows, d = cut_lineage(rows), len(first["features"])
    grown: set[int] = {1}
    for _ in range(max_depth):
        live = tree.routed(rows).where(F.col("node").isin(list(grown))) if len(grown) <= 64 else tree.routed(rows)
        found = [r for r in split_table(live, d, len(classes)).collect() if r["node"] in grown and r["score"] > r["base"] + 1e-12]  # at most a row a node
        if not found:
            break
        middle = {r["node"]: r["value"] + (r["above"] - r["value"]) / 2 for r in found}
        tree.splits.append({r["node"]: (r["feature"], middle[r["node"]] if middle[r["node"]] < r["above"] else r["value"]) for r in found})
        grown = {2 * r["node"] + i for r in found for i in (0, 1)}
    leaf = tree.routed(rows).groupBy("node").agg(*[F.count_if(F.col("y") == i).alias(f"n{i}") for i in range(len(classes))])
    tree.leaves = {r["node"]: [r[f"n{i}"] for i in range(len(classes))] for r in leaf.collect()}
    return tree


# ------------------------------------------------------- softmax boosting
@dataclass
class Tree:
    """Heap-ordered: the root is 1; ``feature`` is -1 at a leaf; a bin above ``cut`` goes right."""
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1)
        return cls(np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        at, row = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(len(self.feature).bit_length() - 2):
            f = self.feature[at]
            at = np.where(f >= 0, 2 * at + (bins[row, f] > self.cut[at]), at)
        return at


def margins(rounds: list[list[Tree]], bins: np.ndarray, k: int) -> np.ndarray:
    out = np.zeros((len(bins), k))
    for trees in rounds:
        for c, t in enumerate(trees):
            out[:, c] += t.value[t.nodes(bins)]
    return out


def slopes(m: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the softmax loss by the margins."""
    p = np.exp(m - m.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    g = p.copy()
    g[np.arange(len(y)), y] -= 1
    return g, p * (1 - p)


def binned(x: np.ndarray, bounds: list[np.ndarray]) -> np.ndarray:
    """Number of a feature's bounds below each value; NaN is above all."""
    out = np.empty(x.shape, np.int64)
    for j, b in enumerate(bounds):
        out[:, j] = np.where(np.isnan(x[:, j]), len(b) + 1, np.searchsorted(b, x[:, j], "left"))
    return out


def _matrix(col: pa.Array, d: int) -> np.ndarray:
    flat = col.flatten()
    return np.asarray(flat.to_numpy(zero_copy_only=False), np.float64).reshape(-1, d)


@dataclass
class SoftmaxTrees:
    classes: list
    bounds: list[np.ndarray]
    rounds: list[list[Tree]] = field(default_factory=list)
    loss: list[float] = field(default_factory=list)  # mean log loss of the training rows before each round

    def predict(self, df: DataFrame, id_col: str = "row_id") -> DataFrame:
        """The class of the largest margin, the first of equal ones; NULL from a model of an empty table."""
        bounds, rounds, k, d = self.bounds, self.rounds, len(self.classes), len(self.bounds)
        if not d:
            return df.select(id_col, F.lit(None).cast("string").alias("predicted"))

        def run(x: pa.Array) -> pa.Array:
            return pa.array(np.argmax(margins(rounds, binned(_matrix(x, d), bounds), k), 1).astype(np.int32), pa.int32())

        return df.select(id_col, _class_of(F.arrow_udf(run, "int")(F.col("features")), self.classes).alias("predicted"))


def _histograms(rows: DataFrame, rounds: list[list[Tree]], trees: list[Tree], level: int, d: int, n_bins: int) -> DataFrame:
    """Sums of slopes by (class, node of the level, feature, bin); feature -1 holds the summed loss."""
    k, low = len(trees), 2 ** level
    if k * low * d * n_bins > MAX_CELLS:
        raise ValueError("classes x nodes x features x bins is too large: use fewer bins or a smaller depth")

    def run(batches):
        g_sum, h_sum, lost = np.zeros((k, low * d * n_bins)), np.zeros((k, low * d * n_bins)), 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, y = _matrix(batch.column(0), d).astype(np.int64), batch.column(1).to_numpy(zero_copy_only=False)
            m = margins(rounds, bins, k)
            g, h = slopes(m, y)
            top = m.max(1)
            lost += float((np.log(np.exp(m - top[:, None]).sum(1)) + top - m[np.arange(len(y)), y]).sum())
            for c, t in enumerate(trees):
                at = t.nodes(bins)
                live = np.flatnonzero((at >= low) & (at < 2 * low))
                cell = (((at[live] - low)[:, None] * d + np.arange(d)) * n_bins + bins[live]).ravel()
                g_sum[c] += np.bincount(cell, np.repeat(g[live, c], d), low * d * n_bins)
                h_sum[c] += np.bincount(cell, np.repeat(h[live, c], d), low * d * n_bins)
        c, cell = np.nonzero(h_sum)
        cols = [c, low + cell // (d * n_bins), cell // n_bins % d, cell % n_bins, g_sum[c, cell], h_sum[c, cell]]
        cols = [np.append(x, v) for x, v in zip(cols, (0, 0, -1, 0, lost, 0.0))]
        yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int32), pa.int32()) for x in cols[:4]), *(pa.array(x, pa.float64()) for x in cols[4:])], names=["c", "node", "f", "b", "g", "h"])

    parts = rows.mapInArrow(run, "c int, node int, f int, b int, g double, h double")
    return parts.groupBy("c", "node", "f", "b").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))


def best_splits(hist: DataFrame, l2: float, min_child: float) -> DataFrame:
    """c, node, f, b, gain, gl, hl, g, h: the split of the largest gain of each node of each tree (the row f = -1 holds the loss in g)."""
    cells = hist.where("f >= 0")
    group = Window.partitionBy("c", "node", "f")  # at most the bins of a feature
    run = cells.withColumn("gl", F.sum("g").over(group.orderBy("b"))).withColumn("hl", F.sum("h").over(group.orderBy("b")))
    run = run.withColumn("gt", F.sum("g").over(group)).withColumn("ht", F.sum("h").over(group))
    part = lambda g, h: g * g / (h + F.lit(l2))
    gr, hr = F.col("gt") - F.col("gl"), F.col("ht") - F.col("hl")
    ok = (F.col("hl") >= min_child) & (hr >= min_child)
    gain = F.when(ok, F.round(part(F.col("gl"), F.col("hl")) + part(gr, hr) - part(F.col("gt"), F.col("ht")), 9)).otherwise(F.lit(0.0))
    best = run.groupBy("c", "node").agg(F.max(F.struct(gain.alias("gain"), (-F.col("f")).alias("f"), (-F.col("b")).alias("b"), "gl", "hl", "gt", "ht")).alias("s"))
    best = best.select("c", "node", (-F.col("s.f")).alias("f"), (-F.col("s.b")).alias("b"), "s.gain", "s.gl", "s.hl", F.col("s.gt").alias("g"), F.col("s.ht").alias("h"))
    return best.unionByName(hist.where("f < 0").select("c", "node", "f", "b", F.lit(0.0).alias("gain"), F.lit(0.0).alias("gl"), F.lit(0.0).alias("hl"), "g", "h"))


def softmax_boosting(df: DataFrame, rounds: int = 20, eta: float = 0.3, max_depth: int = 3, classes: list | None = None, label: str = "label",
                     bins: int = 64, l2: float = 1.0, min_child: float = 1e-3) -> SoftmaxTrees:
    """``rounds`` x classes trees on second-order gradients; one job a level. Bin bounds are approximate quantiles; a feature
    with at most ``bins`` distinct values of even frequency has all of them as bounds."""
    classes = classes or class_list(df.where(F.col(label).isNotNull()), label)
    rows = df.select(F.col("features").cast("array<double>").alias("features"), _class_index(classes, label).alias("y")).where("y >= 0")
    first = rows.first()
    if first is None or not classes:
        return SoftmaxTrees(classes, [])
    d, k = len(first["features"]), len(classes)
    value = F.posexplode("features").alias("f", "x")
    probs = [i / bins for i in range(1, bins)]
    q = rows.select(value).where("x is not null and not isnan(x)").groupBy("f").agg(F.percentile_approx("x", probs, 10_000).alias("q")).collect()  # features x bins numbers
    bounds = [np.zeros(0)] * d
    for r in q:
        bounds[r["f"]] = np.unique(np.array(r["q"], np.float64))
    model = SoftmaxTrees(classes, bounds)

    def cut(x: pa.Array) -> pa.Array:
        b = binned(_matrix(x, d), bounds).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(b) + 1) * d, pa.int32()), pa.array(b.ravel(), pa.int32()))

    rows = cut_lineage(rows.select(F.arrow_udf(cut, "array<int>")(F.col("features")).alias("bins"), "y"))
    n = rows.count()
    for _ in range(rounds):
        trees = [Tree.empty(max_depth) for _ in classes]
        for level in range(max_depth):
            found = best_splits(_histograms(rows, model.rounds, trees, level, d, bins + 1), l2, min_child).collect()  # classes x nodes rows
            if level == 0:
                model.loss.append(next(r["g"] for r in found if r["f"] < 0) / n)
            for r in found:
                if r["f"] < 0:
                    continue
                t, i = trees[r["c"]], r["node"]
                if level == 0:
                    t.value[1] = -eta * r["g"] / (r["h"] + l2)
                if r["gain"] > 1e-9:
                    t.feature[i], t.cut[i] = r["f"], r["b"]
                    t.value[2 * i] = -eta * r["gl"] / (r["hl"] + l2)
                    t.value[2 * i + 1] = -eta * (r["g"] - r["gl"]) / (r["h"] - r["hl"] + l2)
        model.rounds.append(trees)
    return model
