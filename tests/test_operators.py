"""Invariants and brute-force checks of operators whose results are not
checked by SQL twins (or whose fast path differs from the naive one)."""

import itertools

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from foldwise.functions.common import ts_micros

from foldwise import catalog as C
from foldwise.functions import prep as P
from foldwise.operators import neighbors as NB
from foldwise.operators import reduce as RD
from foldwise.operators import scoring as G
from foldwise.operators import splits as SP
from foldwise.operators.sequence import dense_seq, seq_by_hash
from foldwise.sources import driver_tables as dt

SF = "/root/testdata/sf0.001"


def test_dense_seq_equals_row_number(spark):
    ev = dt.events(spark, SF).withColumn("k", ts_micros("ts"))
    got = dense_seq(ev, [F.col("k"), F.col("event_id")], numeric_key="k", n_buckets=7)
    exp = ev.withColumn("rn", F.row_number().over(Window.orderBy("k", "event_id")) - 1)
    j = got.join(exp, "event_id").where(F.col("seq") != F.col("rn"))
    assert j.count() == 0 and got.count() == ev.count()


def test_seq_by_hash_groups_dense(spark):
    o = dt.orders(spark, SF)
    s = seq_by_hash(o, F.md5(F.col("row_id").cast("string")), "row_id", group_cols=["label"], name="p", n_buckets=5)
    per = s.groupBy("label").agg(F.min("p"), F.max("p"), F.count(F.lit(1)), F.count_distinct("p")).collect()
    for r in per:
        assert r[1] == 0 and r[2] == r[3] - 1 and r[4] == r[3]


def test_kfold_sizes_within_one(spark):
    o = dt.orders(spark, SF)
    sizes = [r[1] for r in SP.stratified_kfold(o, 4).groupBy("label", "fold").count().collect()]
    strat = SP.stratified_kfold(o, 4).groupBy("label", "fold").count()
    for lab in [r[0] for r in o.select("label").distinct().collect()]:
        c = [r["count"] for r in strat.where(F.col("label") == lab).collect()]
        assert max(c) - min(c) <= 1
    plain = [r["count"] for r in SP.kfold(o, 7).groupBy("fold").count().collect()]
    assert max(plain) - min(plain) <= 1 and sum(plain) == o.count() and sizes


def test_grouped_kfold_keeps_groups_together(spark):
    o = dt.orders(spark, SF)
    g = SP.grouped_kfold(o, 3)
    assert g.groupBy("grp").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0


def test_kendall_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), f"f{j}", float(rng.integers(0, 6)), int(rng.integers(1, 4))) for i in range(40) for j in range(2)]
    df = spark.createDataFrame(rows, "row_id long, feature string, x double, cls int")
    got = {r.feature: r.score for r in G.kendall_score(df).collect()}
    for f in ("f0", "f1"):
        pts = [(x, c) for _, ff, x, c in rows if ff == f]
        n = len(pts)
        tot = 0
        for a, b in itertools.combinations(pts, 2):
            conc = (a[0] < b[0] and a[1] < b[1]) or (a[0] > b[0] and a[1] > b[1])
            tot += 1 if conc else -1
        assert abs(got[f] - tot / (0.5 * n * n)) < 1e-12


def test_knn_join_matches_numpy(spark):
    d = dt.embeddings(spark, SF)
    got = NB.knn_join(d, d, 4, carry=(), block_rows=64).collect()
    x = {r.row_id: np.array(r.features) for r in d.collect()}
    ids = sorted(x)
    mat = np.stack([x[i] for i in ids])
    for r in got[:200]:
        d2 = ((mat - x[r.query_id]) ** 2).sum(1)
        order = sorted(range(len(ids)), key=lambda j: (round(d2[j], 9), ids[j]))
        assert ids[order[r.rank - 1]] == r.data_id


def test_knn_lsh_falls_back_to_exact(spark):
    d = dt.embeddings(spark, SF)
    exact = {(r.query_id, r.rank): r.data_id for r in NB.knn_join(d, d, 3, carry=()).collect()}
    approx = {(r.query_id, r.rank): r.data_id for r in
              NB.knn_join_lsh(d, d, 3, bucket_length=1e-6, threshold=1e-9, carry=()).collect()}
    assert approx == exact  # nothing found by LSH -> every query takes the exact path


def test_pca_scores_centred_and_uncorrelated(spark):
    d = dt.embeddings(spark, SF)
    m = RD.pca_fit(d, 64, k=3)
    z = np.array([r.features for r in m.transform(d).collect()])
    assert np.allclose(z.mean(0), 0, atol=1e-9)
    c = np.cov(z.T)
    assert np.allclose(c - np.diag(np.diag(c)), 0, atol=1e-9)
    assert all(np.diff(np.diag(c)) <= 1e-12)


def test_ica_output_unit_covariance(spark):
    d = dt.embeddings(spark, SF)
    m = RD.fastica_fit(d, 64, n_components=3, max_iter=10)
    z = np.array([r.features for r in m.transform(d).collect()])
    assert np.allclose(np.cov(z.T, ddof=1), np.eye(3), atol=1e-6)


def test_minmax_on_train_in_unit_range(spark):
    d = SP.hold_out(dt.embeddings(spark, SF), 0.3)
    tr = d.where("split = 'train'")
    out = P.minmax_fit(tr).transform(tr).select(F.explode("features").alias("x")).agg(F.min("x"), F.max("x")).first()
    assert out[0] == 0.0 and out[1] == 1.0


def test_hopfield_ends_in_fixed_point_or_cycle(spark):
    rows = C.q_hopfield_recall(spark, SF).collect()
    assert rows and all(r.steps < 1000 for r in rows)


def test_hopfield_weights_symmetric_zero_diagonal(spark):
    w = {(r.i, r.j): r.w for r in C.q_hebbian(spark, SF).collect()}
    n = spark.read.parquet(f"{SF}/embeddings.parquet").count()
    for (i, j), v in w.items():
        assert v == w[(j, i)]
        assert (v == 0.0) if i == j else abs(v * n - round(v * n)) < 1e-6


def test_confusion_sums_and_trace(spark):
    s = C.q_fold_matrix_sum(spark, SF).groupBy("method").agg(F.sum("n").alias("n")).collect()
    n = spark.read.parquet(f"{SF}/part.parquet").count()
    assert all(r.n == n for r in s)


def test_single_class_and_empty_fold(spark):
    from foldwise.operators import metrics as M
    df = spark.createDataFrame([("a", "a")] * 5, "actual string, predicted string")
    r = M.multiclass_metrics(M.confusion_counts(df, "actual", "predicted"), ["a", "b", "c"]).first()
    assert r.accuracy == 1.0 and r.recall == 1.0 and r.specificity == 1.0


def test_knn_k_larger_than_memory(spark):
    d = dt.embeddings(spark, SF)
    small = d.limit(3)
    got = NB.knn_join(d.limit(5), small, 10, carry=()).groupBy("query_id").count().collect()
    assert all(r["count"] == 3 for r in got)


def test_prequential_svm_accuracies(spark):
    r = C.q_prequential_svm(spark, SF).collect()
    assert len(r) == 0 or all(0 <= x.accuracy <= 1 for x in r)


def test_memory_when_batch_larger_than_window(spark):
    """W < B: memory of batch b is still rows [b*B, b*B + W)."""
    from foldwise.streaming import prequential as W
    df = spark.range(1000).withColumnRenamed("id", "seq")
    mem = W.memory_summary(df, 100, 300).orderBy("batch").collect()
    assert [(r.batch, r.n_memory, r.first_seq, r.last_seq) for r in mem] == \
        [(0, 100, 0, 99), (1, 100, 300, 399), (2, 100, 600, 699)]


def test_five_number_matches_numpy(spark):
    from foldwise.operators import stats as ST
    rng = np.random.default_rng(5)
    rows = [(f"f{j}", float(rng.integers(0, 9)) if j == 0 else float(rng.normal())) for j in range(2) for _ in range(37)]
    df = spark.createDataFrame(rows, "feature string, x double")
    got = {r.feature: r for r in ST.five_number(df).collect()}
    for f in ("f0", "f1"):
        v = np.array([x for ff, x in rows if ff == f])
        q = np.quantile(v, [0.25, 0.5, 0.75])
        r = got[f]
        assert np.allclose([r.min, r.q1, r.median, r.q3, r.max], [v.min(), *q, v.max()])


def test_class_missing_from_a_fold(spark):
    """A class with fewer rows than folds: metrics of folds without it still
    follow the 0/0 -> 1 rule and weights use actual counts."""
    from foldwise.plans.evaluate import evaluate_predictions
    rows = [(i, f, "a" if i % 5 else "b", "a") for i, f in zip(range(20), [1, 2] * 10)]
    rows[0] = (0, 1, "c", "a")  # class c only in fold 1
    pred = spark.createDataFrame(rows, "row_id long, fold int, actual string, predicted string")
    res = evaluate_predictions(pred, ["a", "b", "c"])
    fm = {r.fold: r for r in res.fold_metrics.collect()}
    assert fm[2].n == 10 and 0 <= fm[2].recall <= 1 and fm[1].n == 10
    m = {(r.actual, r.predicted): r.n for r in res.matrix.collect()}
    assert sum(m.values()) == 20 and m[("c", "a")] == 1


def test_empty_input_yields_empty_outputs(spark):
    from foldwise.operators import metrics as M
    e = spark.createDataFrame([], "row_id long, features array<double>, label string")
    assert SP.kfold(e, 5).count() == 0
    assert SP.hold_out(e, 0.2).count() == 0
    c = M.confusion_counts(e.withColumn("p", F.col("label")), "label", "p")
    assert M.multiclass_metrics(c, ["a", "b", "c"]).count() == 0


def test_knn_distance_ties_break_by_id(spark):
    data = spark.createDataFrame([(i, [float(i % 2)], "x") for i in range(10)], "row_id long, features array<double>, label string")
    q = spark.createDataFrame([(100, [0.0], "q")], "row_id long, features array<double>, label string")
    got = [r.data_id for r in NB.knn_join(q, data, 3, carry=()).orderBy("rank").collect()]
    assert got == [0, 2, 4]


def test_binary_labels_use_first_class(spark):
    from foldwise.operators import metrics as M
    df = spark.createDataFrame([("n", "n"), ("n", "y"), ("y", "y"), ("y", "y")], "actual string, predicted string")
    r = M.multiclass_metrics(M.confusion_counts(df, "actual", "predicted"), ["n", "y"]).first()
    # positive class = 'n': tp 1, fn 1, fp 0, tn 2
    assert r.recall == 0.5 and r.precision == 1.0 and r.specificity == 1.0 and r.accuracy == 0.75
