"""Exact k nearest neighbours (C5), kNN vote (M1), bagged kNN (M12) and
local SVM on the neighbours (M10).

Data of more than one block goes to the pruned join of ``voronoi``. Data that
fits one block meets every block of queries, without pair rows:
  * queries are cut into Q blocks by a hash of the id and the data block is
    sent to each (replication N_data * Q rows, never pairs);
  * inside a group numpy computes the distance matrix and keeps the k best
    per query (ties: smaller data id first).

A data row with a missing (NULL, NaN, infinite) feature is nobody's neighbour, and a
query with one has no neighbours: it gets no row here and a NULL prediction below.

Distances are squared Euclidean summed in feature order (the square root
does not change the order) and rounded to ``DIST_DIGITS`` so that engines
summing in a different order still agree on ties.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.operators.voronoi import PrunedJoin, sound
from foldwise.neighbors_shared import empty_frame, feature_columns, stack_columns
from foldwise.session import cut_lineage

DIST_DIGITS = 9
BLOCK_ROWS = 2048
#: queries of one call of the local SVM
LOCAL_QUERIES = 2000


def pairwise_sq(qx: np.ndarray, dx: np.ndarray) -> np.ndarray:
    """Squared distances, accumulated feature by feature (same order as an
    SQL sum over positions 1..d)."""
    out = np.zeros((qx.shape[0], dx.shape[0]))
    for j in range(qx.shape[1]):
        diff = qx[:, j, None] - dx[None, :, j]
        out += diff * diff
    return np.round(out, DIST_DIGITS)


def top_k(d2: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Column indices of the k smallest per row, ordered by (distance, id).
    ``argpartition`` finds the k smallest in O(n); only rows with a tie at
    the k-th distance fall back to a full (distance, id) sort."""
    n = d2.shape[1]
    if n == 0:
        return np.zeros((d2.shape[0], 0), dtype=np.int64)
    kk = min(k, n)
    if kk == n:
        idb = np.broadcast_to(ids, d2.shape)
        return np.lexsort((idb, d2), axis=1)[:, :kk]
    part = np.argpartition(d2, kk - 1, axis=1)[:, :kk]
    vals = np.take_along_axis(d2, part, 1)
    edge = vals.max(1)
    clean = (d2 <= edge[:, None]).sum(1) == kk
    cand_ids = ids[part]
    order = np.lexsort((cand_ids, vals), axis=1)
    out = np.take_along_axis(part, order, 1)
    bad = np.nonzero(~clean)[0]
    if len(bad):
        sub = d2[bad]
        out[bad] = np.lexsort((np.broadcast_to(ids, sub.shape), sub), axis=1)[:, :kk]
    return out


def _blocks(n: int, block_rows: int, parallelism: int = 1, min_rows: int = 256) -> int:
    """Blocks of at most ``block_rows``; small inputs are still cut into up
    to ``parallelism`` blocks (of >= ``min_rows``) so every core works."""
    return max(1, math.ceil(n / block_rows), min(parallelism, math.ceil(n / min_rows)))


def knn_join(queries: DataFrame, data: DataFrame, k: int, *, qid: str = "row_id", did: str = "row_id",
             features: str = "features", carry: tuple[str, ...] = ("label",),
             exclude_same: str | None = None, within: str | None = None,
             block_rows: int = BLOCK_ROWS, scale_by: dict | None = None) -> DataFrame:
    """k nearest data rows of every query row.

    Returns ``query_id, rank (1 = nearest), data_id, dist2, <carry...>``.
    ``exclude_same``: a column present on both sides; pairs with equal values
    are skipped (e.g. ``fold`` for cross-validation in one pass).
    ``within``: a column on both sides; queries only meet data rows with the
    same value (independent searches, e.g. bagging members, in one job).
    ``scale_by``: {value of ``exclude_same``: (lo, hi)} min-max parameters;
    a query with value f and its candidates are both scaled with f's
    parameters (leak-free cross-validation: f's training rows fitted them).
    """
    # one small job per side: row count and vector width together
    st = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(features)).alias("d")).first()
    nq, dim = st["n"], (st["d"] or 0)
    nd = nq if data is queries else data.count()
    par = queries.sparkSession.sparkContext.defaultParallelism
    nqb, ntb = _blocks(nq, block_rows, par), _blocks(nd, block_rows)
    if ntb > 1:
        return PrunedJoin(queries, data, k, dim=dim, n_data=nd, qid=qid, did=did, features=features, carry=carry, exclude_same=exclude_same,
                          within=within, block_rows=block_rows, scale_by=scale_by).neighbours()
    xq = [F.col(exclude_same).alias("_x")] if exclude_same else []
    xq += [F.col(within).alias("_w")] if within else [F.lit(0).alias("_w")]
    fcols = [F.col(features)[i].alias(c) for i, c in enumerate(feature_columns(dim))]
    q = (queries.select(F.col(qid).alias("query_id"), *fcols, *xq)
         .withColumn("_qb", F.pmod(F.xxhash64("query_id"), F.lit(nqb)).cast("int"))
         .withColumn("_tb", F.explode(F.sequence(F.lit(0), F.lit(ntb - 1)))))
    d = (data.select(F.col(did).alias("data_id"), *fcols, *carry, *xq)
         .withColumn("_tb", F.pmod(F.xxhash64("data_id"), F.lit(ntb)).cast("int"))
         .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.lit(nqb - 1)))))
    carry_fields = [data.schema[c] for c in carry]
    wf = [T.StructField(within, queries.schema[within].dataType)] if within else []
    schema = T.StructType([
        *wf,
        T.StructField("query_id", queries.schema[qid].dataType),
        T.StructField("rank", T.IntegerType()),
        T.StructField("data_id", data.schema[did].dataType),
        T.StructField("dist2", T.DoubleType()),
        *[T.StructField(f.name, f.dataType) for f in carry_fields],
    ])
    names = [f.name for f in schema.fields]
    has_x = bool(exclude_same)
    scalers = ({k: (np.asarray(v[0], dtype=np.float64), np.asarray(v[1], dtype=np.float64))
                for k, v in scale_by.items()} if scale_by else None)

    def block(qp: pd.DataFrame, dp: pd.DataFrame) -> pd.DataFrame:
        if len(qp) == 0 or len(dp) == 0:
            return empty_frame(schema)
        qx, dx = stack_columns(qp, dim), stack_columns(dp, dim)
        if scalers is not None:
            d2 = np.full((len(qp), len(dp)), np.inf)
            qf, dfold = qp["_x"].to_numpy(), dp["_x"].to_numpy()
            for f in np.unique(qf):
                lo, hi = scalers[f]
                rq, rd = np.nonzero(qf == f)[0], np.nonzero(dfold != f)[0]
                if len(rd):
                    d2[np.ix_(rq, rd)] = pairwise_sq(_minmax(qx[rq], lo, hi), _minmax(dx[rd], lo, hi))
        else:
            d2 = pairwise_sq(qx, dx)
        d2 = np.where(np.isnan(d2), np.inf, d2)  # a missing feature
        if has_x and scalers is None:
            same = qp["_x"].to_numpy()[:, None] == dp["_x"].to_numpy()[None, :]
            d2 = np.where(same, np.inf, d2)
        ids = dp["data_id"].to_numpy()
        idx = top_k(d2, ids, k)
        rows_q = np.repeat(np.arange(len(qp)), idx.shape[1])
        cols = idx.reshape(-1)
        dist = d2[rows_q, cols]
        ok = np.isfinite(dist)
        rank = np.tile(np.arange(1, idx.shape[1] + 1), len(qp))
        out = {}
        if within:
            out[within] = qp["_w"].to_numpy()[rows_q][ok]
        out |= {
            "query_id": qp["query_id"].to_numpy()[rows_q][ok],
            "rank": rank[ok].astype(np.int32),
            "data_id": ids[cols][ok],
            "dist2": dist[ok],
        }
        for c in carry:
            out[c] = dp[c].to_numpy()[cols][ok]
        return pd.DataFrame(out, columns=names)

    # compute-heavy groups: an explicit partition count keeps AQE from
    # merging the byte-small block shuffle into a few tasks
    npart = max(par, int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))
    keys = ["_w", "_qb", "_tb"]
    part = (q.repartition(npart, *keys).groupBy(*keys)
            .cogroup(d.repartition(npart, *keys).groupBy(*keys))
            .applyInPandas(block, schema))
    return part


def _minmax(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """(x - lo) / (hi - lo); a constant feature maps to 0."""
    span = hi - lo
    out = np.zeros_like(x)
    ok = span != 0
    out[:, ok] = (x[:, ok] - lo[ok]) / span[ok]
    return out


def vote(neighbours: DataFrame, label: str = "label", key: str | list[str] = "query_id",
         out: str = "predicted") -> DataFrame:
    """Majority class of the k nearest; among tied classes the one whose
    last counted vote came earliest (first to reach the top count)."""
    keys = [key] if isinstance(key, str) else list(key)
    per = neighbours.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_votes"),
                                                F.max("rank").alias("_last"))
    w = Window.partitionBy(*keys).orderBy(F.col("_votes").desc(), F.col("_last").asc())
    return (per.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
            .select(*keys, F.col(label).alias(out)))


def knn_classify(train: DataFrame, test: DataFrame, k: int, *, label: str = "label",
                 features: str = "features", id_col: str = "row_id", exclude_same: str | None = None,
                 block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Predicted label of every test row: ``(row_id, predicted)``, NULL without a neighbour."""
    nb = knn_join(test, train, k, qid=id_col, did=id_col, features=features, carry=(label,),
                  exclude_same=exclude_same, block_rows=block_rows)
    return test.select(id_col).join(vote(nb, label).withColumnRenamed("query_id", id_col), id_col, "left")


def fold_minmax(df: DataFrame, fold: str = "fold", features: str = "features") -> dict:
    """Min-max parameters of every fold's TRAINING rows (all other folds),
    from one (fold, position) aggregate: k x d numbers."""
    rows = (df.select(fold, F.posexplode(features).alias("pos", "x")).groupBy(fold, "pos")
            .agg(F.min("x").alias("lo"), F.max("x").alias("hi")).collect())
    folds = sorted({r[fold] for r in rows})
    d = max(r["pos"] for r in rows) + 1
    lo = {f: np.full(d, np.inf) for f in folds}
    hi = {f: np.full(d, -np.inf) for f in folds}
    for r in rows:
        lo[r[fold]][r["pos"]] = r["lo"]
        hi[r[fold]][r["pos"]] = r["hi"]
    out = {}
    for f in folds:
        others = [g for g in folds if g != f]
        out[f] = (np.min([lo[g] for g in others], axis=0), np.max([hi[g] for g in others], axis=0))
    return out


def knn_cross_validate_predictions(df: DataFrame, k: int, fold: str = "fold", label: str = "label",
                                   features: str = "features", id_col: str = "row_id",
                                   block_rows: int = BLOCK_ROWS, scale: str | None = None,
                                   lsh: dict | None = None) -> DataFrame:
    """All folds at once: every row is predicted from the rows of the other
    folds.  ``scale='per_fold'`` min-max scales with each fold's training
    rows only.  Returns ``(row_id, fold, actual, predicted)``."""
    if lsh is not None:
        # approximate candidates for very large tables (exact fallback for
        # queries with fewer than k candidates); global scaling only
        nb = knn_join_lsh(df, df, k, qid=id_col, did=id_col, features=features, carry=(label,),
                          exclude_same=fold, block_rows=block_rows, **lsh)
    else:
        scale_by = fold_minmax(df, fold, features) if scale == "per_fold" else None
        nb = knn_join(df, df, k, qid=id_col, did=id_col, features=features, carry=(label,),
                      exclude_same=fold, block_rows=block_rows, scale_by=scale_by)
    pred = vote(nb, label).withColumnRenamed("query_id", id_col)
    return (df.select(id_col, fold, F.col(label).alias("actual"))
            .join(pred, id_col, "left"))


def bagging_knn_predictions(train: DataFrame, test: DataFrame, k: int, n_members: int,
                            fraction: float, seed: int = 42, label: str = "label",
                            features: str = "features", id_col: str = "row_id",
                            block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Member m trains on the rows whose hash(seed:m:row_id) falls under
    ``fraction`` (sampling without replacement, reproducible), every member
    votes with kNN, and the members' votes are combined by majority
    (ties: smaller label).  One kNN pass keyed by member."""
    members = F.explode(F.sequence(F.lit(0), F.lit(n_members - 1)))
    tr = train.select(id_col, features, label).withColumn("member", members)
    u = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("member").cast("string"),
                                             F.col(id_col).cast("string"))), 1, 8), 16, 10).cast("double")
    tr = tr.where(u / F.lit(16.0 ** 8) < F.lit(fraction))
    te = test.select(id_col, features).withColumn("member", members)
    nbrs = knn_join(te, tr, k, qid=id_col, did=id_col, features=features, carry=(label,),
                    within="member", block_rows=block_rows)
    mv = vote(nbrs, label, ["member", "query_id"]).withColumnRenamed("query_id", id_col)
    cnt = mv.groupBy(id_col, "predicted").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(id_col).orderBy(F.col("_n").desc(), F.col("predicted"))
    voted = cnt.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(id_col, "predicted")
    return test.select(id_col).join(voted, id_col, "left")


def local_svm_predictions(train: DataFrame, test: DataFrame, k: int, C: float = 1.0, *,
                          label: str = "label", features: str = "features", id_col: str = "row_id",
                          block_rows: int = BLOCK_ROWS) -> DataFrame:
    """K nearest rows of each test row; unanimous -> that class, else a
    linear SVM fitted on those k rows predicts.  A group holds the neighbours
    of about ``LOCAL_QUERIES`` queries, and only mixed ones are fitted."""
    from foldwise.functions.svm import DualSVM
    from foldwise.neighbors_shared import stack_vectors

    tr = train.select(id_col, features, label)
    nbrs = knn_join(test, tr, k, qid=id_col, did=id_col, features=features, carry=(label,),
                    block_rows=block_rows)
    # neighbour features and the query's own features, one group per query
    nf = nbrs.join(tr.select(F.col(id_col).alias("data_id"), F.col(features).alias("_nf")), "data_id")
    qf = test.select(F.col(id_col).alias("query_id"), F.col(features).alias("_qf"))
    g = nf.join(qf, "query_id")
    qtype = test.schema[id_col].dataType.simpleString()
    ltype = train.schema[label].dataType.simpleString()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        code, ids = pd.factorize(pdf["query_id"], use_na_sentinel=False)
        order = np.argsort(code, kind="stable")
        labs, nf, qf = (pdf[c].to_numpy()[order] for c in (label, "_nf", "_qf"))
        lab_code = pd.factorize(labs, use_na_sentinel=False)[0]
        edge = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(ids)))])
        out = labs[edge[:-1]].copy()
        mixed = np.maximum.reduceat(lab_code, edge[:-1]) != np.minimum.reduceat(lab_code, edge[:-1])
        for i in np.flatnonzero(mixed):
            own = slice(edge[i], edge[i + 1])
            m = DualSVM("linear", C).fit(stack_vectors(pd.Series(nf[own])), labs[own])
            out[i] = m.predict(stack_vectors(pd.Series(qf[edge[i]:edge[i] + 1])))[0]
        return pd.DataFrame({id_col: ids, "predicted": out})

    groups = max(1, math.ceil(test.count() / LOCAL_QUERIES))
    few = F.pmod(F.xxhash64("query_id"), F.lit(groups))
    spark = test.sparkSession
    n = max(1, min(groups, max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions", "8")))))
    fitted = g.withColumn("_few", few).repartition(n, "_few").groupBy("_few").applyInPandas(fit, f"{id_col} {qtype}, predicted {ltype}")
    return test.select(id_col).join(fitted, id_col, "left")


def knn_join_lsh(queries: DataFrame, data: DataFrame, k: int, *, bucket_length: float, threshold: float,
                 num_tables: int = 3, qid: str = "row_id", did: str = "row_id", features: str = "features",
                 carry: tuple[str, ...] = ("label",), seed: int = 42, block_rows: int = BLOCK_ROWS,
                 exclude_same: str | None = None) -> DataFrame:
    """Approximate kNN for very large tables: candidates are the data rows
    sharing an LSH bucket (random projections, MLlib) within ``threshold``;
    the k best candidates are kept per query.  Queries left with fewer than
    k candidates are answered by the exact blocked join, so every query gets
    k neighbours.  Same output as :func:`knn_join`; ``exclude_same`` drops
    candidate pairs with equal values (cross-validation folds).

    The buckets are compared inside the blocks of the pruned join, so a pair is
    met once (equal rows too, as in MLlib's join of pairs) whatever number of tables it shares, and no pair rows are made."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector, vector_to_array
    dim = queries.agg(F.max(F.size(features)).alias("d")).first()["d"] or 0
    vec = lambda df: df.where(sound(features, dim)).withColumn("_v", array_to_vector(features))
    dv = vec(data)
    n_data = dv.count()
    cols = ["query_id", "rank", "data_id", "dist2", *carry]
    exact = lambda some: knn_join(some, data, k, qid=qid, did=did, features=features, carry=carry, block_rows=block_rows, exclude_same=exclude_same).select(*cols)
    if not n_data:
        return exact(queries)
    model = BucketedRandomProjectionLSH(inputCol="_v", outputCol="_h", bucketLength=bucket_length,
                                        numHashTables=num_tables, seed=seed).fit(dv)
    keys = F.array(*[vector_to_array(F.col("_h")[t])[0].cast("bigint") for t in range(num_tables)])
    hashed = lambda df: model.transform(df).withColumn("_keys", keys).drop("_v", "_h")
    # equal rows are one candidate, and one query
    once = lambda df, *cols: df.select(*dict.fromkeys([*cols, features, *([exclude_same] if exclude_same else [])])).distinct()
    top = cut_lineage(PrunedJoin(hashed(vec(once(queries, qid))), hashed(vec(once(data, did, *carry))), k, dim=dim, n_data=n_data, qid=qid, did=did, features=features, carry=carry,
                                 exclude_same=exclude_same, block_rows=block_rows, hashes="_keys").neighbours().where(F.col("dist2") < threshold * threshold))
    full = top.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k).select("query_id")
    short = cut_lineage(queries.join(full.select(F.col("query_id").alias(qid)), qid, "left_anti"))
    top_full = top.join(full, "query_id", "left_semi").select(*cols)
    return top_full if short.isEmpty() else top_full.unionByName(exact(short))
