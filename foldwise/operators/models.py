"""Classifiers trained on Spark (M2-M7, M11, M13, G5 helper).

* MLlib where it exists: decision tree, linear SVM (one-vs-rest), GBT
  (one-vs-rest), multilayer perceptron (L-BFGS), logistic regression.
* Kernel SVMs: Nystroem landmark features (a bounded, hash-sampled set of
  training rows) followed by the linear SVM, i.e. an approximation.
* Networks with the reference's training loop (full-batch Adam, early
  stopping on a validation split, loss history, relu/tanh/sigmoid, cascade
  growth): data-parallel gradient.  Every epoch one job: each partition
  computes its loss/gradient sums in numpy (``mapInPandas``), the driver
  adds the sums (parameter-sized) and takes the Adam step.
* AdaBoost (SAMME) on weighted MLlib stumps; lineage is cut by a reliable
  checkpoint every few rounds.

Every fitted model has ``predict(df) -> (row_id, predicted)``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    OneVsRest,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.prep import class_list
from foldwise.functions.svm import kernel
from foldwise.neighbors_shared import stack_vectors
from foldwise.session import cut_lineage


def _indexed(df: DataFrame, classes: list, features: str = "features", label: str = "label") -> DataFrame:
    """features -> ML vector, label -> 0-based index in ``classes``."""
    cls = F.array(*[F.lit(str(c)) for c in classes])
    out = df.withColumn("_vec", array_to_vector(F.col(features)))
    if label in df.columns:
        out = out.withColumn("_y", (F.array_position(cls, F.col(label).cast("string")) - 1).cast("double"))
    return out


def _decode(pred_col: str, classes: list):
    cls = F.array(*[F.lit(str(c)) for c in classes])
    return F.element_at(cls, F.col(pred_col).cast("int") + 1)


@dataclass
class MLlibModel:
    model: object
    classes: list
    features: str = "features"
    prep: object = None  # optional feature map (e.g. Nystroem)

    def scored(self, df: DataFrame, id_col: str = "row_id") -> DataFrame:
        d = self.prep.transform(df, self.features) if self.prep is not None else df
        return self.model.transform(_indexed(d, self.classes, self.features, label="__none__"))

    def predict(self, df: DataFrame, id_col: str = "row_id") -> DataFrame:
        s = self.scored(df, id_col)
        return s.select(id_col, _decode("prediction", self.classes).alias("predicted"))


def _fit(est, df, classes, features="features", label="label", prep=None) -> MLlibModel:
    d = _indexed(prep.transform(df, features) if prep is not None else df, classes, features, label)
    if prep is not None:  # MLlib reads the rows twice and more, and a mapped row costs far more than a stored one
        d = d.select("_vec", "_y").persist()
    m = est.setFeaturesCol("_vec").setLabelCol("_y").fit(d)
    if prep is not None:
        d.unpersist()
    return MLlibModel(m, classes, features, prep)


def decision_tree(df: DataFrame, max_depth: int, classes: list | None = None, seed: int = 1,
                  max_bins: int = 256, label: str = "label") -> MLlibModel:
    """M2: CART with Gini; MLlib bins continuous features (``max_bins``)."""
    classes = classes or class_list(df, label)
    est = DecisionTreeClassifier(maxDepth=max_depth, impurity="gini", maxBins=max_bins, seed=seed)
    return _fit(est, df, classes, label=label)


def linear_svm(df: DataFrame, C: float = 1.0, classes: list | None = None, max_iter: int = 50,
               label: str = "label", prep=None, n_train: int | None = None) -> MLlibModel:
    """M3 linear: hinge loss, regParam = 1/(C n), no standardisation,
    one-vs-rest for more than two classes."""
    classes = classes or class_list(df, label)
    n = n_train or df.count()
    svc = LinearSVC(regParam=1.0 / (C * n), maxIter=max_iter, standardization=False, tol=1e-4)
    est = svc if len(classes) <= 2 else OneVsRest(classifier=svc)
    return _fit(est, df, classes, label=label, prep=prep)


@dataclass
class Nystroem:
    """phi(x) = K(x, L) K(L, L)^(-1/2) for a bounded landmark set L."""
    landmarks: np.ndarray
    proj: np.ndarray
    kind: str
    gamma: float
    degree: int
    coef0: float

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        lm, pj = self.landmarks, self.proj
        kind, g, deg, c0 = self.kind, self.gamma, self.degree, self.coef0
        from pyspark.sql import types as T
        out_cols = [c for c in df.columns if c != features]
        schema = df.select(*out_cols).schema.add(features, T.ArrayType(T.DoubleType()))
        width, names = lm.shape[1], [*out_cols, features]

        def fn(batches):
            for b in batches:
                if b.num_rows == 0:
                    continue
                col = b.column(features)
                if col.null_count or not np.all(np.diff(col.offsets.to_numpy()) == width):
                    raise ValueError(f"a row hasn't {width} features")
                x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
                z = kernel(x, lm, kind, g, deg, c0) @ pj
                flat = pa.array(z.ravel(), pa.float64(), from_pandas=True)
                edges = pa.array(np.arange(len(z) + 1, dtype=np.int32) * z.shape[1])
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in out_cols), pa.ListArray.from_arrays(edges, flat)], names=names)

        return df.mapInArrow(fn, schema)


def nystroem_fit(df: DataFrame, kind: str = "rbf", gamma: float = 1.0, degree: int = 3,
                 coef0: float = 0.0, n_landmarks: int = 200, seed: int = 42,
                 id_col: str = "row_id", features: str = "features") -> Nystroem:
    """Landmarks: the ``n_landmarks`` rows with the smallest md5(seed:id)
    (a bounded, reproducible sample: at most n_landmarks x d numbers reach
    the driver)."""
    from foldwise.functions.common import hash_key
    rows = (df.select(features, hash_key(id_col, seed).alias("_h")).orderBy("_h")
            .limit(n_landmarks).collect())
    lm = np.array([r[features] for r in rows], dtype=np.float64)
    kmm = kernel(lm, lm, kind, gamma, degree, coef0)
    w, v = np.linalg.eigh(kmm)
    w = np.maximum(w, 1e-10)
    proj = v @ np.diag(1.0 / np.sqrt(w)) @ v.T
    return Nystroem(lm, proj, kind, gamma, degree, coef0)


def svm(df: DataFrame, kind: str = "rbf", C: float = 1.0, gamma: float = 1.0, degree: int = 3,
        coef0: float = 0.0, classes: list | None = None, label: str = "label",
        n_landmarks: int = 200) -> MLlibModel:
    """M3: linear kernel exactly (MLlib); other kernels through Nystroem."""
    classes = classes or class_list(df, label)
    if kind == "linear":
        return linear_svm(df, C, classes, label=label)
    ny = nystroem_fit(df, kind, gamma, degree, coef0, n_landmarks)
    return linear_svm(df, C, classes, label=label, prep=ny)


def svm_support_rows(model: MLlibModel, df: DataFrame, id_col: str = "row_id", label: str = "label",
                     eps: float = 1e-6) -> DataFrame:
    """M4: rows on or inside the margin, y f(x) <= 1 + eps; with more than two
    classes, of any of the one-against-rest machines."""
    s = model.scored(df.select(id_col, model.features, label), id_col)
    raw = vector_to_array("rawPrediction")
    if len(model.classes) < 2:
        return s.where(raw[1] <= 1 + eps).select(id_col)
    inside = None
    for i in [1] if len(model.classes) == 2 else range(len(model.classes)):
        y = F.when(F.col(label).cast("string") == str(model.classes[i]), F.lit(1.0)).otherwise(F.lit(-1.0))
        c = y * raw[i] <= 1 + eps
        inside = c if inside is None else inside | c
    return s.where(inside).select(id_col)


def svm_incremental(df: DataFrame, batch_col: str = "batch", C: float = 1.0, kind: str = "linear",
                    gamma: float = 1.0, id_col: str = "row_id", label: str = "label",
                    checkpoint_every: int = 1):
    """M5: train on batch 0; then on each batch plus the previous model's
    support rows; the last model wins.  Support rows are a DataFrame (never
    collected); lineage is cut every few steps.  Returns (model, steps)."""
    classes = class_list(df, label)
    df = cut_lineage(df)
    batches = sorted(r[0] for r in df.select(batch_col).distinct().collect())
    support = None
    model = None
    steps = []
    for i, b in enumerate(batches):
        cur = df.where(F.col(batch_col) == b)
        train = cur if support is None else cur.unionByName(support)
        model = svm(train, kind, C, gamma, classes=classes, label=label)
        sv_ids = svm_support_rows(model, train, id_col, label)
        support = train.join(sv_ids, id_col, "left_semi")
        if (i + 1) % checkpoint_every == 0:
            support = cut_lineage(support)
        steps.append(b)
    return model, support, steps


def gradient_boosting(df: DataFrame, rounds: int = 20, eta: float = 0.2, max_depth: int = 3,
                      classes: list | None = None, label: str = "label", seed: int = 1) -> MLlibModel:
    """Boosted trees; GBT is binary in MLlib, so one-vs-rest above 2."""
    classes = classes or class_list(df, label)
    gbt = GBTClassifier(maxIter=rounds, stepSize=eta, maxDepth=max_depth, seed=seed)
    return _fit(gbt if len(classes) <= 2 else OneVsRest(classifier=gbt, parallelism=len(classes)), df, classes, label=label)


def mlp_lbfgs(df: DataFrame, topology: list[int], classes: list | None = None, max_iter: int = 100,
              label: str = "label", seed: int = 1) -> MLlibModel:
    """M6(a): sigmoid hidden layers + softmax output, L-BFGS (MLlib)."""
    classes = classes or class_list(df, label)
    d = len(df.select("features").first()[0])
    est = MultilayerPerceptronClassifier(layers=[d, *topology, len(classes)], maxIter=max_iter, seed=seed)
    return _fit(est, df, classes, label=label)


def logistic(df: DataFrame, classes: list | None = None, label: str = "label", max_iter: int = 100) -> MLlibModel:
    classes = classes or class_list(df, label)
    return _fit(LogisticRegression(maxIter=max_iter, family="multinomial"), df, classes, label=label)


# --------------------------------------------------------------------- AdaBoost
@dataclass
class AdaBoost:
    stumps: list
    alphas: list
    classes: list

    def predict(self, df: DataFrame, id_col: str = "row_id") -> DataFrame:
        d = _indexed(df.select(id_col, "features"), self.classes, label="__none__")
        score = None
        for i, (m, a) in enumerate(zip(self.stumps, self.alphas)):
            p = m.setPredictionCol(f"_p{i}").setRawPredictionCol(f"_r{i}").setProbabilityCol(f"_q{i}").transform(d)
            d = p.drop(f"_r{i}", f"_q{i}")
        k = len(self.classes)
        votes = F.array(*[sum((F.when(F.col(f"_p{i}") == c, F.lit(a)).otherwise(F.lit(0.0))
                               for i, a in enumerate(self.alphas)), F.lit(0.0)) for c in range(k)])
        best = F.array_position(votes, F.array_max(votes)) - 1
        return d.select(id_col, _decode_expr(best, self.classes).alias("predicted"))


def _decode_expr(idx, classes):
    return F.element_at(F.array(*[F.lit(str(c)) for c in classes]), idx.cast("int") + 1)


def adaboost_stumps(df: DataFrame, n_iter: int = 10, classes: list | None = None, label: str = "label",
                    checkpoint_every: int = 4) -> AdaBoost:
    """SAMME with depth-1 trees.  Each round: fit on weights, weighted
    error (one aggregate), alpha = ln((1-err)/err) + ln(K-1), re-weight."""
    classes = classes or class_list(df, label)
    k = len(classes)
    d = _indexed(df, classes, label=label).select("_vec", "_y").withColumn("_w", F.lit(1.0))
    stumps, alphas = [], []
    for i in range(n_iter):
        m = DecisionTreeClassifier(maxDepth=1, featuresCol="_vec", labelCol="_y", weightCol="_w",
                                   predictionCol="_p").fit(d)
        p = m.transform(d).select("_vec", "_y", "_w", "_p")
        miss = (F.col("_p") != F.col("_y")).cast("double")
        tot = p.agg(F.sum(F.col("_w") * miss).alias("e"), F.sum("_w").alias("w")).first()
        err = max(tot["e"] / tot["w"], 1e-12)
        if err >= 1 - 1.0 / k:
            break
        alpha = math.log((1 - err) / err) + math.log(k - 1)
        stumps.append(m.setFeaturesCol("_vec"))
        alphas.append(alpha)
        d = p.select("_vec", "_y", (F.col("_w") * F.exp(F.lit(alpha) * miss) / F.lit(tot["w"])).alias("_w"))
        if (i + 1) % checkpoint_every == 0:
            d = cut_lineage(d)
    return AdaBoost(stumps, alphas, classes)


# ------------------------------------------------------- data-parallel networks
ACTS = {
    "sigmoid": (lambda z: 1 / (1 + np.exp(-z)), lambda a: a * (1 - a)),
    "tanh": (np.tanh, lambda a: 1 - a * a),
    "relu": (lambda z: np.maximum(z, 0), lambda a: (a > 0).astype(np.float64)),
    "identity": (lambda z: z, lambda a: np.ones_like(a)),
}


def _init_layers(sizes_in: list[int], sizes_out: list[int], seed: int) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    params = []
    for i, o in zip(sizes_in, sizes_out):
        lim = math.sqrt(6.0 / (i + o))  # Glorot uniform
        params += [rng.uniform(-lim, lim, (i, o)), np.zeros(o)]
    return params


def net_forward(params, acts, x, cascade: bool):
    """Returns the list of layer activations; the last is the output."""
    outs = [x]
    n_hidden = len(acts)
    for h in range(n_hidden):
        inp = np.hstack(outs) if cascade else outs[-1]
        w, b = params[2 * h], params[2 * h + 1]
        outs.append(ACTS[acts[h]][0](inp @ w + b))
    inp = np.hstack(outs) if cascade else outs[-1]
    w, b = params[-2], params[-1]
    z = inp @ w + b
    if z.shape[1] == 1:
        out = 1 / (1 + np.exp(-z))
    else:
        z = z - z.max(1, keepdims=True)
        e = np.exp(z)
        out = e / e.sum(1, keepdims=True)
    return outs, out


def net_loss_grad(params, acts, x, y, cascade: bool, mask=None):
    """Sum of cross-entropy over rows and its gradient (sums, not means)."""
    outs, out = net_forward(params, acts, x, cascade)
    eps = 1e-7
    if out.shape[1] == 1:
        p = np.clip(out, eps, 1 - eps)
        loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()
    else:
        loss = -(y * np.log(np.clip(out, eps, 1.0))).sum()
    delta = out - y  # dL/dz for sigmoid+BCE and softmax+CE
    grads = [None] * len(params)
    n_hidden = len(acts)
    inp = np.hstack(outs) if cascade else outs[-1]
    grads[-2], grads[-1] = inp.T @ delta, delta.sum(0)
    d_inp = delta @ params[-2].T
    # split the gradient flowing into each earlier output
    widths = [o.shape[1] for o in outs]
    if cascade:
        d_outs = np.split(d_inp, np.cumsum(widths)[:-1], axis=1)
    else:
        d_outs = [None] * n_hidden + [d_inp]
    for h in range(n_hidden - 1, -1, -1):
        a = outs[h + 1]
        d_a = d_outs[h + 1]
        dz = d_a * ACTS[acts[h]][1](a)
        inp = np.hstack(outs[: h + 1]) if cascade else outs[h]
        grads[2 * h], grads[2 * h + 1] = inp.T @ dz, dz.sum(0)
        d_in = dz @ params[2 * h].T
        if cascade:
            parts = np.split(d_in, np.cumsum(widths[: h + 1])[:-1], axis=1)
            for j, pj in enumerate(parts):
                d_outs[j] = pj if d_outs[j] is None else d_outs[j] + pj
        else:
            d_outs[h] = d_in
    if mask is not None:
        grads = [g * m for g, m in zip(grads, mask)]
    return loss, grads


@dataclass
class Network:
    params: list
    acts: list
    classes: list
    cascade: bool = False
    history: dict = field(default_factory=dict)

    def predict(self, df: DataFrame, id_col: str = "row_id") -> DataFrame:
        params, acts, cascade, classes = self.params, self.acts, self.cascade, self.classes
        ltype = "string"

        def fn(it):
            for pdf in it:
                if len(pdf) == 0:
                    continue
                _, out = net_forward(params, acts, stack_vectors(pdf["features"]), cascade)
                if out.shape[1] == 1:
                    idx = np.where(out[:, 0] >= 0.5, 0, 1)
                else:
                    idx = out.argmax(1)
                yield pd.DataFrame({id_col: pdf[id_col], "predicted": [str(classes[i]) for i in idx]})

        itype = df.schema[id_col].dataType.simpleString()
        return df.select(id_col, "features").mapInPandas(fn, f"{id_col} {itype}, predicted {ltype}")


def _targets(labels: np.ndarray, classes: list) -> np.ndarray:
    if len(classes) <= 2:
        return (labels == str(classes[0])).astype(np.float64)[:, None]
    return (labels[:, None] == np.array([str(c) for c in classes])[None, :]).astype(np.float64)


def _distributed_loss_grad(parts: DataFrame, params, acts, classes, cascade, mask=None):
    """ONE job per call: ``parts`` holds train (``_part`` 0), validation (1)
    and test (2) rows; every partition returns its loss sums per part and
    the gradient sum of the training rows.  Returns (mean losses, grads)."""
    shapes = [p.shape for p in params]

    def fn(it):
        loss, n, acc = np.zeros(3), np.zeros(3, dtype=np.int64), None
        for pdf in it:
            if len(pdf) == 0:
                continue
            part = pdf["_part"].to_numpy()
            x = stack_vectors(pdf["features"])
            y = _targets(pdf["label"].astype(str).to_numpy(), classes)
            for k in (0, 1, 2):
                sel = part == k
                if not sel.any():
                    continue
                lk, g = net_loss_grad(params, acts, x[sel], y[sel], cascade, mask)
                loss[k] += lk
                n[k] += int(sel.sum())
                if k == 0:
                    flat = np.concatenate([gi.ravel() for gi in g])
                    acc = flat if acc is None else acc + flat
        if n.sum():
            yield pd.DataFrame({"v": [[*loss.tolist(), *n.tolist(), *(acc.tolist() if acc is not None else [])]]})

    # losses, counts and the gradient in one array, summed by position in Spark:
    # what reaches the driver has the size of the parameters, whatever the number of tasks
    sums = (parts.select("features", "label", "_part").mapInPandas(fn, "v array<double>")
            .select(F.posexplode("v").alias("i", "v")).groupBy("i").agg(F.sum("v").alias("v")).toPandas())
    total = np.zeros(6 + sum(int(np.prod(s_)) for s_ in shapes))
    total[sums["i"].to_numpy()] = sums["v"].to_numpy()
    loss, n, flat = total[:3], total[3:6], total[6:]
    means = [loss[k] / n[k] if n[k] else float("nan") for k in range(3)]
    grads, off = [], 0
    for s_ in shapes:
        size = int(np.prod(s_))
        grads.append(flat[off:off + size].reshape(s_) / max(n[0], 1))
        off += size
    return means, grads


def train_network(train: DataFrame, topology: list[int], classes: list | None = None,
                  transfer: list[str] | None = None, max_epochs: int = 1000, min_loss: float = 0.0,
                  learning_rate: float = 0.01, val: DataFrame | None = None, test: DataFrame | None = None,
                  max_epochs_val: int = 20, seed: int = 1, cascade: bool = False,
                  init: Network | None = None, mask=None, loss_window: int = 0,
                  min_change: float = 0.0) -> Network:
    """M6(b): full-batch Adam.  Losses of train/val/test are recorded from
    epoch 0; with a validation set the net with the best validation loss is
    returned and training stops after ``max_epochs_val`` epochs without a
    better one.  With ``loss_window`` it also stops once the training loss
    changed by less than the share ``min_change`` over that many epochs."""
    classes = classes or class_list(train, "label")
    d = len(train.select("features").first()[0])
    n_out = 1 if len(classes) <= 2 else len(classes)
    acts = list(transfer or ["sigmoid"] * len(topology))
    if init is not None:
        params = [p.copy() for p in init.params]
    else:
        ins, outs = [], []
        width = d
        for h in topology:
            ins.append(width if not cascade else d + sum(topology[:len(ins)]))
            outs.append(h)
            width = h
        ins.append(width if not cascade else d + sum(topology))
        outs.append(n_out)
        params = _init_layers(ins, outs, seed)
    m_t = [np.zeros_like(p) for p in params]
    v_t = [np.zeros_like(p) for p in params]
    b1, b2, eps = 0.9, 0.999, 1e-8
    hist = {"train": [], "val": [], "test": []}
    parts = train.select("features", "label", F.lit(0).alias("_part"))
    if val is not None:
        parts = parts.unionByName(val.select("features", "label", F.lit(1).alias("_part")))
    if test is not None:
        parts = parts.unionByName(test.select("features", "label", F.lit(2).alias("_part")))

    # read once per epoch: written once to the shared folder
    parts = cut_lineage(parts)

    def record(means):
        hist["train"].append(means[0])
        if val is not None:
            hist["val"].append(means[1])
        if test is not None:
            hist["test"].append(means[2])

    means, grads = _distributed_loss_grad(parts, params, acts, classes, cascade, mask)
    record(means)
    loss = means[0]
    best, best_val, since = [p.copy() for p in params], means[1] if val is not None else math.inf, 0
    epoch = 0
    while epoch < max_epochs and loss > min_loss:
        epoch += 1
        for i, g in enumerate(grads):
            m_t[i] = b1 * m_t[i] + (1 - b1) * g
            v_t[i] = b2 * v_t[i] + (1 - b2) * g * g
            mh = m_t[i] / (1 - b1 ** epoch)
            vh = v_t[i] / (1 - b2 ** epoch)
            params[i] = params[i] - learning_rate * mh / (np.sqrt(vh) + eps)
        means, grads = _distributed_loss_grad(parts, params, acts, classes, cascade, mask)
        record(means)
        loss = means[0]
        if val is not None:
            if means[1] < best_val:
                best_val, best, since = means[1], [p.copy() for p in params], 0
            else:
                since += 1
                if since >= max_epochs_val:
                    break
        past = hist["train"][-1 - loss_window] if 0 < loss_window < len(hist["train"]) else None
        if past is not None and abs(loss - past) / max(abs(past), 1e-12) < min_change:
            break
    final = best if val is not None else params
    return Network(final, acts, classes, cascade, hist)


def cascade_network(train: DataFrame, max_neurons: int, classes: list | None = None,
                    transfer: str = "sigmoid", epochs_per_stage: int = 20, learning_rate: float = 0.01,
                    window: int = 5, min_change: float = 0.001, min_loss: float = 0.0, seed: int = 1) -> Network:
    """M7: start without hidden units; add one unit at a time until there are
    ``max_neurons`` (it sees the inputs and every earlier unit; its output
    weight starts at 0).  From the second unit on the new unit's weights are
    trained alone first (gradient mask); then all weights.  A stage ends when
    the relative loss change over ``window`` epochs is small; the next unit is
    still added.  ``history`` holds the losses of all stages."""
    classes = classes or class_list(train, "label")
    train = cut_lineage(train.select("features", "label"))
    stage = dict(max_epochs=epochs_per_stage, learning_rate=learning_rate, cascade=True, min_loss=min_loss,
                 loss_window=window, min_change=min_change)
    net = train_network(train, [], classes, [], seed=seed, **stage)
    losses = list(net.history["train"])
    n_in = len(train.select("features").first()[0])
    for h in range(1, max_neurons + 1):
        d_in = n_in + h - 1
        rng = np.random.default_rng(seed + h)
        lim = math.sqrt(6.0 / (d_in + 1))
        old = net.params
        hidden = old[:-2]
        w_new, b_new = rng.uniform(-lim, lim, (d_in, 1)), np.zeros(1)
        w_out = np.vstack([old[-2], np.zeros((1, old[-2].shape[1]))])
        params = hidden + [w_new, b_new, w_out, old[-1]]
        acts = net.acts + [transfer]
        net = Network(params, acts, classes, True)
        if h > 1:
            mask = [np.zeros_like(p) for p in params]
            mask[-4:] = [np.ones_like(p) for p in params[-4:]]
            net = train_network(train, [1] * h, classes, acts, init=net, mask=mask, **stage)
            losses += net.history["train"][1:]
        net = train_network(train, [1] * h, classes, acts, init=net, **stage)
        losses += net.history["train"][1:]
    net.history["train"] = losses
    return net
