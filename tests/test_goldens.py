"""Portable golden values of the reference's assert scripts (FIXTURES.md
part 3), recomputed with our operators."""

import math

import pytest
from pyspark.sql import functions as F

from foldwise.functions import prep as P
from foldwise.operators import metrics as M
from foldwise.operators import splits as SP


def approx(a, b, tol=1e-6):
    return abs(a - b) <= tol


def test_one_hot_iris_blocks(iris):
    enc, classes = P.one_hot(iris, "label")
    rows = enc.orderBy("row_id").select("onehot").collect()
    assert len(rows) == 150 and len(classes) == 3
    for i, r in enumerate(rows):
        assert r[0] == [j == i // 50 for j in range(3)]


def test_minmax_and_zscore_iris(iris):
    mm = P.minmax_fit(iris).transform(iris)
    st = mm.select(F.posexplode("features").alias("p", "x")).groupBy("p").agg(F.min("x"), F.max("x")).collect()
    assert all(r[1] == 0.0 and r[2] == 1.0 for r in st)
    zs = P.zscore_fit(iris).transform(iris)
    st = zs.select(F.posexplode("features").alias("p", "x")).groupBy("p").agg(F.avg("x"), F.stddev_samp("x")).collect()
    assert all(abs(r[1]) <= 1e-4 and approx(r[2], 1.0, 1e-6) for r in st)


def test_minmax_constant_column_is_zero(spark):
    df = spark.createDataFrame([(0, [1.0, 5.0]), (1, [1.0, 7.0])], "row_id long, features array<double>")
    out = P.minmax_fit(df).transform(df).orderBy("row_id").collect()
    assert [r.features for r in out] == [[0.0, 0.0], [0.0, 1.0]]


def test_classify_outputs(spark):
    df = spark.createDataFrame([(i, (i + 1) / 10) for i in range(10)], "i int, s double")
    got = [r[0] for r in df.orderBy("i").select(P.classify_outputs("s", 0.65, multi=False)).collect()]
    assert got == [False] * 6 + [True] * 4
    m = spark.createDataFrame([(0, [1.0, 2.0, 3.0]), (1, [3.0, 2.0, 1.0]), (2, [2.0, 3.0, 1.0]), (3, [2.0, 1.0, 3.0])], "i int, s array<double>")
    got = [r[0] for r in m.orderBy("i").select(P.one_hot_decode(P.classify_outputs("s"))).collect()]
    assert got == [3, 1, 2, 3]


def test_accuracy_goldens(spark, iris):
    # [sin cos tan](1..150) against iris one-hot -> 0.34
    s = iris.select("row_id", "label").withColumn("i", F.col("row_id") + 1)
    s = s.withColumn("scores", F.array(F.sin("i"), F.cos("i"), F.tan("i")))
    enc, _ = P.one_hot(s, "label")
    pred = enc.withColumn("p", P.classify_outputs("scores"))
    acc = M.accuracy_onehot(pred, "onehot", "p").first()[0]
    assert approx(acc, 0.34)
    # 1, 149/150, ..., 1/150 with threshold .75 against class 1 -> 0.92
    t = enc.withColumn("score", 1 - F.col("row_id") / 150.0).withColumn("y", F.col("onehot")[0])
    acc2 = M.accuracy(t.withColumn("p", F.col("score") >= 0.75), "y", "p").first()[0]
    assert approx(acc2, 0.92)


def _binary_df(spark, outputs, targets):
    return spark.createDataFrame(list(zip(outputs, targets)), "o double, t boolean")


def test_confusion_binary_goldens(spark):
    outs = [math.sin(i) for i in range(1, 9)]
    tgts = [False] * 4 + [True] * 4
    df = _binary_df(spark, outs, tgts).withColumn("p", F.col("o") >= 0)
    r = M.confusion_binary(df, "t", "p").first()
    assert (r.tn, r.fp, r.fn, r.tp) == (1, 3, 2, 2)
    assert approx(r.accuracy, .375) and approx(r.recall, .5) and approx(r.specificity, .25)
    assert approx(r.precision, .4) and approx(r.npv, 1 / 3) and approx(r.f1, 4 / 9)
    r = M.confusion_binary(_binary_df(spark, outs, tgts), "t", "o", threshold=0.9).first()
    assert (r.tn, r.fp, r.fn, r.tp) == (3, 1, 3, 1)
    assert approx(r.accuracy, .5) and approx(r.recall, .25) and approx(r.specificity, .75)
    assert approx(r.precision, .5) and approx(r.npv, .5) and approx(r.f1, 1 / 3)


def test_confusion_three_class_golden(spark):
    pairs = [(a, p) for a in "abc" for p in "abc"]
    df = spark.createDataFrame(pairs, "actual string, predicted string")
    counts = M.confusion_counts(df, "actual", "predicted")
    r = M.multiclass_metrics(counts, ["a", "b", "c"]).first()
    assert approx(r.accuracy, 1 / 3) and approx(r.recall, 1 / 3) and approx(r.specificity, 2 / 3)
    assert approx(r.precision, 1 / 3) and approx(r.npv, 2 / 3) and approx(r.f1, 1 / 3)
    cells = {(c.actual, c.predicted): c.n for c in M.confusion_matrix(counts, ["a", "b", "c"]).collect()}
    assert set(cells.values()) == {1}


def test_confusion_labels_golden(iris):
    classes = ["Iris-setosa", "Iris-versicolor", "Iris-virginica"]
    df = iris.withColumn("predicted", F.element_at(F.array(*[F.lit(c) for c in classes]),
                                                   (F.col("row_id") % 3 + 1).cast("int")))
    counts = M.confusion_counts(df, "label", "predicted")
    r = M.multiclass_metrics(counts, classes).first()
    assert approx(r.accuracy, 1 / 3) and approx(r.specificity, 2 / 3)
    cells = {(c.actual, c.predicted): c.n for c in M.confusion_matrix(counts, classes).collect()}
    got = [[cells[(a, p)] for p in classes] for a in classes]
    assert got == [[17, 17, 16], [17, 16, 17], [16, 17, 17]]


def test_cyclical_golden(spark):
    vals = [1, 2, 3, 2, 1, 0, -1, -2, -3]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i int, x double")
    cyc = P.cyclical_fit(df, "x")
    s, c = cyc.columns("x")
    got = df.orderBy("i").select(s, c).collect()
    exp_s = [-.433884, -.974928, -.781831, -.974928, -.433884, .433884, .974928, .781831, 0]
    exp_c = [-.900969, -.222521, .623490, -.222521, -.900969, -.900969, -.222521, .623490, 1]
    for r, es, ec in zip(got, exp_s, exp_c):
        assert approx(r[0], es, 1e-6) and approx(r[1], ec, 1e-6)


def test_cyclical_constant_and_empty(spark):
    df = spark.createDataFrame([(0, 4.0), (1, 4.0)], "i int, x double")
    s, c = P.cyclical_fit(df, "x").columns("x")
    assert df.select(s, c).distinct().collect()[0] == (0.0, 1.0)
    empty = spark.createDataFrame([], "i int, x double")
    s, c = P.cyclical_fit(empty, "x").columns("x")
    assert empty.select(s, c).count() == 0


def test_batches_golden(spark):
    df = spark.range(208).withColumnRenamed("id", "row_id")
    df = SP.row_seq(df, "row_id")
    sizes = [r[1] for r in SP.batches(df, 100).groupBy("batch").count().orderBy("batch").collect()]
    assert sizes == [100, 100, 8]


@pytest.mark.parametrize("n,w,b,expected", [(45312, 1000, 100, 444), (45312, 1000, 500, 89), (45312, 500, 500, 90)])
def test_stream_batch_counts(n, w, b, expected):
    from foldwise.streaming.prequential import batch_count
    assert batch_count(n, w, b) == expected


def test_crop_golden(spark):
    df = spark.createDataFrame([(0, [True] * 64)], "row_id long, pixels array<boolean>")
    px = df.select(P.crop("pixels", 8, 0.25)).first()[0]
    for r in range(8):
        assert px[r * 8: r * 8 + 6] == [True] * 6 and px[r * 8 + 6: r * 8 + 8] == [False, False]


def test_critical_difference_5x5():
    from foldwise.operators.compare import critical_difference_value
    assert approx(critical_difference_value(5, 5), 2.728, 1e-9)
