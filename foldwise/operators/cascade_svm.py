"""Exact kernel SVMs on distributed rows (M3-M5): a cascade of dual solvers.

* One machine per pair of classes (M3's multi-class vote); all pairs go through the same jobs.
* Rows are dealt to nodes of at most about ``leaf_rows`` rows. Every node solves its dual and passes on its
  support rows only; nodes are merged two by two, layer by layer, until one node a pair is left.
* The machine of the last node is checked on ALL rows: a row that isn't in it must have y f(x) >= 1 - eps. Rows that
  don't are dealt to nodes again, each with the machine's support rows, and the cascade runs once more. The objective grows with every round, so it
  ends; then the optimality (KKT) conditions of the whole problem hold to ``eps``: the result is that of one solver over all rows.

A node holds support rows only above the first layer. Where a problem keeps more than ``max_rows`` of them a node refuses (a
ValueError names the Nystroem form of ``models.svm``) rather than drop any.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.functions.prep import class_list
from foldwise.functions.smo import solve
from foldwise.functions.svm import kernel
from foldwise.neighbors_shared import stack_vectors
from foldwise.session import cut_lineage

LEAF_ROWS, MAX_ROWS, MAX_MODEL_BYTES, EPS = 1000, 20_000, 256 << 20, 1e-3


@dataclass
class CascadeSVM:
    """``machines``: {(i, j): (support features, alpha * y, rho)} over pairs of class positions; y is 1 for class i.
    ``support``: pair, id, features, y, alpha of every support row, as a DataFrame."""

    classes: list
    kernel_args: tuple
    C: float
    machines: dict
    support: DataFrame
    rounds: int
    features: str = "features"
    id_col: str = "row_id"

    def decisions(self, x: np.ndarray) -> np.ndarray:
        """One column per pair."""
        out = np.zeros((len(x), len(self.machines)))
        for c, (sv, coef, rho) in enumerate(self.machines.values()):
            out[:, c] = (kernel(x, sv, *self.kernel_args) @ coef if len(sv) else 0.0) - rho
        return out

    def _scorer(self):
        machines, args, n = self.machines, self.kernel_args, len(self.classes)
        held = CascadeSVM(self.classes, args, self.C, machines, None, self.rounds)

        def vote(x: np.ndarray) -> np.ndarray:
            if n == 1:
                return np.zeros(len(x), np.int64)
            d = held.decisions(x)
            votes = np.zeros((len(x), n), np.int64)
            for c, (i, j) in enumerate(machines):
                votes[:, i] += d[:, c] > 0
                votes[:, j] += d[:, c] <= 0
            return votes.argmax(1)

        return vote

    def predict(self, df: DataFrame, id_col: str = "row_id") -> DataFrame:
        """(id, predicted); among classes with equal votes the first one. A row with a missing feature has no prediction."""
        vote, classes = self._scorer(), [str(c) for c in self.classes]

        def score(col: pd.Series) -> pd.Series:
            ok = col.map(lambda v: v is not None and not pd.isna(np.asarray(v, dtype=np.float64)).any()).to_numpy(bool)
            out = np.full(len(col), None, object)
            if ok.any():
                out[ok] = np.array(classes, object)[vote(stack_vectors(col[ok]))]
            return pd.Series(out)

        return df.select(id_col, F.pandas_udf(score, "string")(F.col(self.features)).alias("predicted"))


NODE = "pair int, node int, id {id}, f array<double>, y double, alpha double, rho double"


def _pair_rows(df: DataFrame, classes: list, label: str, id_col: str, features: str) -> DataFrame:
    """(pair, id, f, y): each row once for every pair that its class is in. Rows without a label of ``classes`` or with a missing feature are left out."""
    pairs = [(i, j) for i in range(len(classes)) for j in range(i + 1, len(classes))]
    lab = F.col(label).cast("string")
    of = F.array(*[F.struct(F.lit(p).alias("pair"), F.when(lab == str(classes[i]), 1.0).when(lab == str(classes[j]), -1.0).alias("y")) for p, (i, j) in enumerate(pairs)])
    rows = df.where(F.col(features).isNotNull() & ~F.exists(features, lambda v: v.isNull() | F.isnan(v)))
    rows = rows.select(F.col(id_col).alias("id"), F.col(features).cast("array<double>").alias("f"), F.explode(of).alias("p"))
    return rows.select(F.col("p.pair").alias("pair"), "id", "f", F.col("p.y").alias("y")).where("y is not null")


def _spread(rows: DataFrame, n: int, leaf_rows: int) -> DataFrame:
    """Rows dealt to as many tasks as their number needs: a small file is one task, however long its rows take to score."""
    spark = rows.sparkSession
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return rows.repartition(max(1, min(most, n // leaf_rows)), "pair", "id")


def _solver(C: float, args: tuple, tol: float, max_rows: int, carried):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pair, node = int(pdf["pair"].iloc[0]), int(pdf["node"].iloc[0])
        if carried is not None and pair in carried.value:  # the last machine's support rows join every node of the first layer
            pdf = pd.concat([pdf[["id", "f", "y"]], carried.value[pair]])
        pdf = pdf.drop_duplicates("id").sort_values("id")
        if len(pdf) > max_rows:
            raise ValueError(f"{len(pdf)} support rows meet in one node (max_rows {max_rows}); models.svm has an approximation for such problems")
        y = pdf["y"].to_numpy()
        alpha, rho = solve(stack_vectors(pdf["f"]), y, C, *args, tol=tol)
        keep = alpha > 0
        if not keep.any():  # a node of one class: one row goes on, others come back if the check finds them
            keep[0] = True
        out = pdf[keep]
        return pd.DataFrame({"pair": np.int32(pair), "node": np.int32(node // 2), "id": out["id"], "f": out["f"], "y": out["y"], "alpha": alpha[keep], "rho": rho})

    return run


def cascade_svm(df: DataFrame, kind: str = "rbf", C: float = 1.0, gamma: float = 1.0, degree: int = 3, coef0: float = 0.0, *, classes: list | None = None, label: str = "label",
                features: str = "features", id_col: str = "row_id", leaf_rows: int = LEAF_ROWS, max_rows: int = MAX_ROWS, eps: float = EPS, max_rounds: int = 50) -> CascadeSVM:
    """M3, exactly: kernels linear, rbf exp(-gamma |x - z|^2), poly (gamma x.z + coef0)^degree, sigmoid tanh(gamma x.z + coef0).
    Ids must be unique. Rows with a missing feature or label aren't trained on; a class without rows wins no pair.
    Not converged after ``max_rounds`` raises an error."""
    spark = df.sparkSession
    classes = classes if classes is not None else class_list(df.where(F.col(label).isNotNull()), label)
    if kind not in ("linear", "rbf", "poly", "sigmoid"):
        raise ValueError(f"unknown kernel {kind}")
    args = (kind, gamma, degree, coef0)
    pairs = [(i, j) for i in range(len(classes)) for j in range(i + 1, len(classes))]
    id_type = df.schema[id_col].dataType.simpleString()
    empty = spark.createDataFrame([], T.StructType.fromDDL(f"pair int, id {id_type}, f array<double>, y double, alpha double"))
    if not pairs:
        return CascadeSVM(classes, args, C, {}, empty, 0, features, id_col)
    rows = _pair_rows(df, classes, label, id_col, features)
    n_bad = {r["pair"]: r["n"] for r in rows.groupBy("pair").agg(F.count("*").alias("n")).collect()}
    rows = cut_lineage(_spread(rows, sum(n_bad.values()), leaf_rows))
    machines: dict = {p: (np.zeros((0, 0)), np.zeros(0), 0.0) for p in pairs}
    carried, support, rounds = None, empty, 0
    violating = rows
    while n_bad:
        rounds += 1
        if rounds > max_rounds:
            raise RuntimeError(f"the cascade did not converge in {max_rounds} rounds")
        nodes = max(1, -(-max(n_bad.values()) // leaf_rows))
        tol = eps / 10
        layer = violating.select("pair", F.pmod(F.xxhash64("id"), F.lit(nodes)).cast("int").alias("node"), "id", "f", "y")
        fit = _solver(C, args, tol, max_rows, carried)
        while True:
            groups = min(nodes * len(n_bad), max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))
            layer = cut_lineage(layer.repartition(groups, "pair", "node").groupBy("pair", "node").applyInPandas(fit, NODE.format(id=id_type)))
            if nodes == 1:
                break
            nodes = -(-nodes // 2)
            fit = _solver(C, args, tol, max_rows, None)
        done = layer.where("alpha > 0")
        old = support.join(F.broadcast(spark.createDataFrame([(p,) for p in n_bad], "pair int")), "pair", "left_anti")
        support = cut_lineage(old.unionByName(done.select("pair", "id", "f", "y", "alpha")))
        size = done.agg(F.count("*"), F.max(F.size("f"))).first()
        if (size[0] or 0) * (size[1] or 0) * 8 > MAX_MODEL_BYTES:
            raise ValueError("the support rows are more than a broadcast model may hold")
        got = done.select("pair", "id", "f", "y", "alpha", "rho").toPandas()  # at most max_rows a pair
        alone = layer.groupBy("pair").agg(F.first("rho").alias("rho")).collect()
        for r in alone:
            part = got[got["pair"] == r["pair"]].sort_values("id")
            x = stack_vectors(part["f"]) if len(part) else np.zeros((0, 0))
            machines[pairs[r["pair"]]] = (x, (part["alpha"] * part["y"]).to_numpy(), float(r["rho"]))
        held = spark.sparkContext.broadcast((machines, pairs))
        by_pair = {int(p): g[["id", "f", "y"]] for p, g in support.select("pair", "id", "f", "y").toPandas().groupby("pair")}
        carried = spark.sparkContext.broadcast(by_pair)
        violating, n_bad = _violating(rows, support, held, args, eps)
    return CascadeSVM(classes, args, C, machines, support, rounds, features, id_col)


def _margin(held, args: tuple):
    """Column y f(x) of a row of ``_pair_rows``."""

    def margin(pair: pd.Series, f: pd.Series, y: pd.Series) -> pd.Series:
        machines, pairs = held.value
        out = np.zeros(len(f))
        for p in pair.unique():
            at = np.flatnonzero(pair.to_numpy() == p)
            sv, coef, rho = machines[pairs[p]]
            for lo in range(0, len(at), 1024):
                some = at[lo:lo + 1024]
                out[some] = (kernel(stack_vectors(f.iloc[some]), sv, *args) @ coef if len(sv) else 0.0) - rho
        return pd.Series(out * y.to_numpy())

    return F.pandas_udf(margin, "double")("pair", "f", "y")


def _violating(rows: DataFrame, support: DataFrame, held, args: tuple, eps: float) -> tuple[DataFrame, dict]:
    """Rows outside the machines with y f(x) < 1 - eps, and their number for each pair that has any."""

    scored = rows.withColumn("margin", _margin(held, args)).where(F.col("margin") < 1 - eps)
    bad = cut_lineage(scored.drop("margin").join(support.select("pair", "id"), ["pair", "id"], "left_anti"))
    return bad, {r["pair"]: r["n"] for r in bad.groupBy("pair").agg(F.count("*").alias("n")).collect()}


def kkt_report(model: CascadeSVM, df: DataFrame, label: str = "label", eps: float = 2 * EPS) -> DataFrame:
    """Per pair of classes over all its rows: n_rows, n_support, n_bound (alpha = C), violations of the optimality
    conditions by more than ``eps``, and balance (sum of alpha y)."""
    spark = df.sparkSession
    pairs = list(model.machines)
    rows = _pair_rows(df, model.classes, label, model.id_col, model.features)
    rows = _spread(rows, rows.count(), LEAF_ROWS)
    held, args, C = spark.sparkContext.broadcast((model.machines, pairs)), model.kernel_args, model.C

    m = _margin(held, args)
    all_ = rows.join(model.support.select("pair", "id", "alpha"), ["pair", "id"], "left").withColumn("a", F.coalesce("alpha", F.lit(0.0))).withColumn("m", m)
    bad = ((F.col("a") < C) & (F.col("m") < 1 - eps)) | ((F.col("a") > 0) & (F.col("m") > 1 + eps))
    return all_.groupBy("pair").agg(F.count("*").alias("n_rows"), F.count_if(F.col("a") > 0).alias("n_support"), F.count_if(F.col("a") >= C).alias("n_bound"),
                                    F.count_if(bad).alias("violations"), F.sum(F.col("a") * F.col("y")).alias("balance"))


def support_rows(model: CascadeSVM, carried: DataFrame | None = None) -> DataFrame:
    """M4: one row per support row of any pair: id and ``carried``, true for the rows of ``carried`` (those kept from before), false for new ones."""
    ids = model.support.select(F.col("id").alias(model.id_col)).distinct()
    if carried is None:
        return ids.withColumn("carried", F.lit(False))
    old = carried.select(model.id_col).distinct().withColumn("carried", F.lit(True))
    return ids.join(old, model.id_col, "left").withColumn("carried", F.coalesce("carried", F.lit(False)))


def cascade_incremental(df: DataFrame, kind: str = "rbf", C: float = 1.0, gamma: float = 1.0, degree: int = 3, coef0: float = 0.0, *, batch_col: str = "batch", label: str = "label",
                        features: str = "features", id_col: str = "row_id", **kw) -> tuple[CascadeSVM, DataFrame, DataFrame]:
    """M5: the first batch, then each batch with the support rows before it; the last machine wins.
    (model, its support rows with all their columns, steps: batch, n_support, n_carried, n_new)."""
    classes = kw.pop("classes", None) or class_list(df.where(F.col(label).isNotNull()), label)
    df = cut_lineage(df)
    support, model, steps = None, None, []
    for b in sorted(r[0] for r in df.select(batch_col).distinct().collect()):
        now = df.where(F.col(batch_col) == b)
        train = now if support is None else now.unionByName(support)
        model = cascade_svm(train, kind, C, gamma, degree, coef0, classes=classes, label=label, features=features, id_col=id_col, **kw)
        split = support_rows(model, support)
        support = cut_lineage(train.join(split.select(id_col), id_col, "left_semi"))
        n = split.agg(F.count_if("carried"), F.count_if(~F.col("carried"))).first()
        steps.append((b, n[0] + n[1], n[0], n[1]))
    kind_ = df.schema[batch_col].dataType.simpleString()
    return model, support, df.sparkSession.createDataFrame(steps, f"{batch_col} {kind_}, n_support long, n_carried long, n_new long")
