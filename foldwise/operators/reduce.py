"""Dimensionality reduction fitted on Spark aggregates (H1-H5).

Covariance, class means and scatter matrices are additive sums computed on
the executors (d x d numbers reach the driver); the eigen-decomposition of
that d x d matrix runs on the driver; projection is a JVM-side expression
(one dot product per output column), so applying a model never leaves
whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.neighbors_shared import stack_vectors
from foldwise.operators.stats import column_means, covariance, gram
from foldwise.session import cut_lineage


def _matrix(long_df: DataFrame, d: int, value: str) -> np.ndarray:
    m = np.zeros((d, d))
    for r in long_df.collect():
        m[r["i"], r["j"]] = r[value]
    return m


def _fix_signs(vecs: np.ndarray) -> np.ndarray:
    """Largest |component| of every vector positive (stable across runs)."""
    idx = np.abs(vecs).argmax(0)
    s = np.sign(vecs[idx, np.arange(vecs.shape[1])])
    s[s == 0] = 1
    return vecs * s


@dataclass
class Projection:
    """x -> (x - centre) @ W, as Spark expressions."""
    centre: np.ndarray
    w: np.ndarray  # d x k
    explained: np.ndarray | None = None

    def transform(self, df: DataFrame, features: str = "features", out: str | None = None) -> DataFrame:
        out = out or features
        cols = []
        for j in range(self.w.shape[1]):
            wj = F.array(*[F.lit(float(v)) for v in self.w[:, j]])
            bias = float(np.dot(self.centre, self.w[:, j]))
            dot = F.aggregate(F.zip_with(F.col(features), wj, lambda x, w: x * w), F.lit(0.0), lambda a, v: a + v)
            cols.append(dot - F.lit(bias))
        return df.withColumn(out, F.array(*cols))


def pca_fit(df: DataFrame, d: int, k: int | None = None, threshold: float | None = None,
            features: str = "features") -> Projection:
    """H1/H2: centre, covariance on Spark, eigh on the driver; keep k
    components, or the fewest whose cumulative variance ratio reaches
    ``threshold`` (ratio of the total variance)."""
    means = column_means(df, features)
    cov = _matrix(covariance(df, d, features, means), d, "cov")
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = vals[order], vecs[:, order]
    ratio = vals / vals.sum() if vals.sum() > 0 else np.zeros_like(vals)
    if k is None:
        k = int(np.searchsorted(np.cumsum(ratio), threshold - 1e-12) + 1) if threshold is not None else d
        k = min(k, d)
    return Projection(np.asarray(means), _fix_signs(vecs[:, :k]), ratio[:k])


def lda_fit(df: DataFrame, d: int, features: str = "features", label: str = "label",
            max_components: int = 5) -> Projection:
    """H3: S_W = sum over classes of the scatter around the class mean,
    S_B = sum_c n_c (m_c - m)(m_c - m)^T; directions = eigenvectors of
    pinv(S_W) S_B (real part), top min(max_components, K - 1)."""
    per = (df.select(label, F.posexplode(features).alias("pos", "x"))
           .groupBy(label, "pos").agg(F.sum("x").alias("s"), F.count(F.lit(1)).alias("n")).collect())
    classes = sorted({r[label] for r in per})
    sums = {c: np.zeros(d) for c in classes}
    counts = {c: 0 for c in classes}
    for r in per:
        sums[r[label]][r["pos"]] = r["s"]
        counts[r[label]] = r["n"]
    n = sum(counts.values())
    mu = sum(sums.values()) / n
    total = _matrix(gram(df, d, features), d, "s")
    sb = np.zeros((d, d))
    sw = total.copy()
    for c in classes:
        mc = sums[c] / counts[c]
        sw -= counts[c] * np.outer(mc, mc)
        sb += counts[c] * np.outer(mc - mu, mc - mu)
    vals, vecs = np.linalg.eig(np.linalg.pinv(sw) @ sb)
    order = np.argsort(-vals.real)
    k = min(max_components, len(classes) - 1, d)
    w = _fix_signs(vecs[:, order[:k]].real)
    return Projection(np.zeros(d), w, vals.real[order[:k]])


def fastica_fit(df: DataFrame, d: int, n_components: int | None = None, tol: float = 1e-4,
                max_iter: int = 200, seed: int = 1, features: str = "features") -> Projection:
    """H4: feature-space FastICA (logcosh): centre, whiten with the
    covariance, then per iteration ONE Spark aggregate for all components:
    E[z g(W z)] and E[g'(W z)], symmetric decorrelation on the driver; stop
    when every |w . w_prev| > 1 - tol (or ``max_iter``)."""
    k = n_components or d
    means = np.asarray(column_means(df, features))
    cov = _matrix(covariance(df, d, features, list(means)), d, "cov")
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1][:k]
    vals, vecs = np.maximum(vals[order], 1e-12), vecs[:, order]
    white = vecs / np.sqrt(vals)  # d x k: z = (x - mu) @ white
    rng = np.random.default_rng(seed)
    w = _sym_decorrelate(rng.standard_normal((k, k)))
    sel = cut_lineage(df.select(features))  # read once per iteration
    for _ in range(max_iter):
        w_prev = w

        def part(it, w=w):
            acc_zg = np.zeros((k, k))
            acc_gp = np.zeros(k)
            n = 0
            for pdf in it:
                if len(pdf) == 0:
                    continue
                z = (stack_vectors(pdf[features], d) - means) @ white
                y = z @ w.T
                g = np.tanh(y)
                acc_zg += g.T @ z
                acc_gp += (1 - g * g).sum(0)
                n += len(pdf)
            if n:
                yield pd.DataFrame({"zg": [acc_zg.ravel().tolist()], "gp": [acc_gp.tolist()], "n": [n]})

        rows = sel.mapInPandas(part, "zg array<double>, gp array<double>, n long").collect()
        n = sum(r["n"] for r in rows)
        zg = np.sum([np.asarray(r["zg"]) for r in rows], axis=0).reshape(k, k) / n
        gp = np.sum([np.asarray(r["gp"]) for r in rows], axis=0) / n
        w = _sym_decorrelate(zg - gp[:, None] * w)
        if np.max(np.abs(np.abs(np.einsum("ij,ij->i", w, w_prev)) - 1)) < tol:
            break
    unmix = white @ w.T  # d x k
    return Projection(means, _fix_signs(unmix))


def _sym_decorrelate(w: np.ndarray) -> np.ndarray:
    s, u = np.linalg.eigh(w @ w.T)
    return u @ np.diag(1.0 / np.sqrt(np.maximum(s, 1e-12))) @ u.T @ w
