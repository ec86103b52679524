"""Joins, streams and models that grow with their input: the same results in a form that doesn't."""

import os
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from foldwise.functions.svm import DualSVM, _near, kernel
from foldwise.operators import neighbors as NB
from foldwise.operators import scoring as G
from foldwise.operators import stats as ST
from foldwise.operators import voronoi as V
from foldwise.streaming import live


def vectors(spark, n, d=5, seed=1):
    x = np.random.default_rng(seed).normal(size=(n, d)).round(3)
    pdf = pd.DataFrame({"row_id": range(n), "features": x.tolist(), "label": [f"l{i % 3}" for i in range(n)], "fold": [i % 4 for i in range(n)]})
    return spark.createDataFrame(pdf).cache(), x


def test_a_query_travels_once_a_shelf(spark):
    df, _ = vectors(spark, 1200)
    j = V.PrunedJoin(df, df, 3, dim=5, n_data=1200, block_rows=40)
    sent, salts = j._sent()
    # 30 blocks and more lie on one shelf: every query is sent to it once, not to each block
    assert j.n_blocks >= 30 and len(salts) == 1 and sent.agg(F.sum("n")).first()[0] == 1200


def test_several_shelves_equal_one_block(spark, monkeypatch):
    monkeypatch.setattr(V, "SHELF_ROWS", 150)
    df, _ = vectors(spark, 1000, seed=2)
    kw = {"exclude_same": "fold", "scale_by": NB.fold_minmax(df)}
    rows = lambda d: sorted(map(tuple, d.collect()))
    assert rows(NB.knn_join(df, df, 3, block_rows=50, **kw)) == rows(NB.knn_join(df, df, 3, block_rows=10_000, **kw))


def test_lsh_candidates_without_pair_rows(spark):
    """The k best of the pairs that share a bucket, as MLlib's join of pairs finds them."""
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector

    df, _ = vectors(spark, 300, seed=3)
    v = df.select("row_id", "fold", array_to_vector("features").alias("_v"))
    m = BucketedRandomProjectionLSH(inputCol="_v", outputCol="_h", bucketLength=0.7, numHashTables=2, seed=42).fit(v)
    want = {}
    for a, b, fa, fb, d in m.approxSimilarityJoin(v, v, 2.0, distCol="d").select("datasetA.row_id", "datasetB.row_id", "datasetA.fold", "datasetB.fold", "d").toDF("a", "b", "fa", "fb", "d").collect():
        if fa != fb:
            want.setdefault(a, []).append((round(d * d, 6), b))
    got = NB.knn_join_lsh(df, df, 3, bucket_length=0.7, threshold=2.0, num_tables=2, exclude_same="fold", block_rows=64)
    assert "approxSimilarity" not in got._jdf.queryExecution().toString() and got.count() == 900
    mine = {}
    for r in got.collect():
        mine.setdefault(r.query_id, []).append((r.rank, round(r.dist2, 6), r.data_id))
    full = [q for q, found in want.items() if len(found) >= 3]
    assert full and all([x[1:] for x in sorted(mine[q])] == sorted(want[q])[:3] for q in full)


def test_few_features_are_not_few_tasks(spark):
    df = spark.range(1000).selectExpr("IF(id % 2 = 0, 'a', 'b') AS feature", "CAST(id % 50 AS DOUBLE) AS x", "CAST(id % 3 AS INT) AS cls")
    for q in (ST.histogram(df, 10), G.mutual_information(df, 5)):
        assert "BroadcastHashJoin" in q._jdf.queryExecution().toString() or "ResolvedHint (strategy=broadcast)" in q._jdf.queryExecution().toString()
    assert sum(r.n for r in ST.histogram(df, 10).collect()) == 1000


def test_sparse_kernel_gives_the_same_machine():
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.exponential(50, 700), rng.normal(size=(700, 2))])
    y = np.where(rng.random(700) < 0.3, "true", "false")
    assert _near(x, "rbf", 2.0) is not None and _near(x / 100, "rbf", 2.0) is None and _near(x, "linear", 2.0) is None
    m = DualSVM("rbf", 1.0, 2.0).fit(x, y)
    s = np.where(y == "true", 1.0, -1.0)
    a = m.alpha
    g = ((kernel(x, x, "rbf", 2.0) + 1) * s[:, None] * s[None, :]) @ a - 1  # optimality over the dense matrix
    assert np.abs(np.clip(a - g, 0, 1) - a).max() < 0.05
    dense = DualSVM("rbf", 1.0, 2.0)
    import foldwise.functions.svm as S
    old, S._near = S._near, lambda *_: None
    try:
        dense.fit(x, y)
    finally:
        S._near = old
    assert np.allclose(dense.alpha, a, atol=1e-8) and (dense.predict(x) == m.predict(x)).all()


def test_isvm_steps_across_jobs(spark, monkeypatch):
    from foldwise.sources.files import scratch_path

    x = np.random.default_rng(5).normal(size=(230, 2))
    df = spark.createDataFrame([(i, [float(v) for v in x[i]], "u" if x[i, 0] + 0.3 * x[i, 1] > 0 else "d") for i in range(230)], "seq long, features array<double>, label string")
    found = []
    for steps in (1, 3, 50):
        monkeypatch.setattr(live, "STEPS", steps)
        base = scratch_path(spark, f"test-isvm-{uuid.uuid4().hex[:8]}")
        found.append(sorted(map(tuple, live.prequential_isvm(df, 60, 20, base).collect())))
        assert len(os.listdir(os.path.join(base.removeprefix("file:"), "isvm_steps"))) == -(-12 // steps)
    assert found[0] == found[1] == found[2] and len(found[0]) == 11 and found[0][-1][1] == 10


def test_local_svm_of_many_queries_a_call(spark, monkeypatch):
    df, x = vectors(spark, 200, d=2, seed=6)
    df = df.withColumn("label", (F.col("features")[0] > 0).cast("string"))
    tr, te = df.where("row_id % 4 <> 0"), df.where("row_id % 4 = 0")
    want = sorted(map(tuple, NB.local_svm_predictions(tr, te, 7).collect()))
    monkeypatch.setattr(NB, "LOCAL_QUERIES", 1)
    assert sorted(map(tuple, NB.local_svm_predictions(tr, te, 7).collect())) == want and len(want) == 50


def test_first_guess_uses_every_training_text(spark):
    from foldwise.llm import hmm_lm as H

    texts = [(i, np.array([i % 7, 3, H.END], np.uint16).tobytes(), i % 10 != 0) for i in range(6000)]
    rows = spark.createDataFrame(texts, "uid long, classes binary, train boolean")
    sent = spark.sparkContext.broadcast((np.full((H.CLASSES, 4), -5.0), np.log(np.full(4, 0.25))))
    in_state, counts, _ = H._mixed(rows, sent, 4)
    assert abs(in_state.sum() - 5400) < 1e-6 and abs(counts.sum() - 16200) < 1e-6 and abs(counts[H.END].sum() - 5400) < 1e-6


def test_lsh_counts_equal_rows_once(spark):
    df, _ = vectors(spark, 200, seed=7)
    kw = {"bucket_length": 4.0, "threshold": 9.0, "num_tables": 2, "block_rows": 64}
    want = sorted(map(tuple, NB.knn_join_lsh(df, df, 3, **kw).collect()))
    twice = df.unionByName(df.where("row_id % 2 = 0"))
    assert sorted(map(tuple, NB.knn_join_lsh(twice, twice, 3, **kw).collect())) == want and len(want) == 600


def test_a_mapped_row_is_mapped_once_a_fit(spark):
    from foldwise.operators import models as MD

    df, x = vectors(spark, 200, d=3, seed=6)
    two = df.select("row_id", "features", F.when(F.col("row_id") % 2 == 0, "a").otherwise("b").alias("label"))
    ny = MD.nystroem_fit(two, "rbf", 0.5, n_landmarks=20)
    met = spark.sparkContext.accumulator(0)

    class Counted:
        def transform(self, rows, features="features"):
            def seen(batches):
                for b in batches:
                    met.add(b.num_rows)
                    yield b

            mapped = ny.transform(rows, features)
            return mapped.mapInArrow(seen, mapped.schema)

    MD.linear_svm(two, 1.0, ["a", "b"], prep=Counted())
    assert met.value == 200  # MLlib reads its rows at least twice
    got = np.array([r.features for r in ny.transform(two).orderBy("row_id").collect()])
    assert np.allclose(got, kernel(x, ny.landmarks, "rbf", 0.5) @ ny.proj, atol=1e-6)


def test_rows_of_one_file_are_scored_by_several_tasks(spark, monkeypatch):
    from foldwise.operators import cascade_svm as CS

    df, x = vectors(spark, 600, d=2, seed=7)
    two = df.select("row_id", "features", F.when(F.col("features")[0] > 0.2, "a").otherwise("b").alias("label")).coalesce(1)
    parts, cut = [], CS.cut_lineage
    monkeypatch.setattr(CS, "cut_lineage", lambda rows: parts.append(rows.rdd.getNumPartitions()) or cut(rows))
    m = CS.cascade_svm(two, "rbf", 1.0, 0.5, leaf_rows=100)
    assert parts[0] == 6 and CS.kkt_report(m, two).first()["violations"] == 0


def test_pivots_are_met_by_few_rows_at_a_time(monkeypatch):
    rng = np.random.default_rng(8)
    x, centers = rng.random((3000, 2)), rng.random((512, 2))
    whole, sizes, far = V._far(x, centers), [], V._far
    monkeypatch.setattr(V, "_far", lambda a, b: sizes.append(len(a)) or far(a, b))
    cell, dist = V._nearest(x, centers)
    assert max(sizes) <= 256 and sum(sizes) == 3000
    assert (cell == whole.argmin(1)).all() and np.allclose(dist, whole.min(1), atol=1e-12)
