"""Rows with missing keys or values stay; text files of several parts keep their order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.functions.svm import DualSVM
from foldwise.operators import models as MD
from foldwise.operators import reduce as RD
from foldwise.operators import splits as SP
from foldwise.operators import stats as ST
from foldwise.operators.neighbors import knn_classify, local_svm_predictions
from foldwise.sources import files as FS


def rows_with_nulls(spark):
    return spark.createDataFrame([(i, None if i % 4 == 0 else "ab"[i % 2], None if i % 5 == 0 else i % 3) for i in range(40)], "row_id long, label string, grp int")


def test_splits_keep_rows_with_null_keys(spark):
    d = rows_with_nulls(spark)
    assert SP.stratified_kfold(d, 5).count() == 40
    folds = SP.grouped_kfold(d, 3)
    assert folds.count() == 40 and folds.where("grp is null").select("fold").distinct().count() == 1
    assert SP.group_hold_out(d, 0.4).count() == 40
    assert SP.kfold(d.withColumn("row_id", F.when(F.col("row_id") > 5, F.col("row_id"))), 4).count() == 40


def test_five_number_ignores_missing(spark):
    x = [None] * 50 + [float("nan")] * 7 + [float(v) for v in range(50, 150)] + [60.0] * 500
    d = spark.createDataFrame([("f", v) for v in x], "feature string, x double")
    r = ST.five_number(d, n_buckets=4).first()
    want = np.quantile([v for v in x if v is not None and v == v], [0, 0.25, 0.5, 0.75, 1])
    assert np.allclose([r["min"], r.q1, r.median, r.q3, r["max"]], want)


def test_query_with_a_missing_feature_has_no_prediction(spark):
    train = spark.createDataFrame([(i, [float(i), 0.0], "ab"[i > 4]) for i in range(10)], "row_id long, features array<double>, label string")
    test = spark.createDataFrame([(100, [9.0, 0.0]), (101, [float("nan"), 0.0]), (102, [None, 1.0])], "row_id long, features array<double>")
    got = {r.row_id: r.predicted for r in knn_classify(train, test, 3).collect()}
    assert got == {100: "b", 101: None, 102: None}


def test_text_parts_keep_their_order(spark, tmp_path):
    n = 60
    for folder, cuts in (("x", [0, 5, 50, n]), ("y", [0, 30, 32, n])):
        (tmp_path / folder).mkdir()
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            lines = [f"{i} 1,2\t{i}.5 0 0 0 0" if folder == "x" else ("UP" if i % 3 else "DOWN") for i in range(a, b)]
            (tmp_path / folder / f"part-{k}.txt").write_text("\n".join(lines) + "\n\n")
    got = FS.read_stream_files(spark, str(tmp_path / "x"), str(tmp_path / "y")).orderBy("seq").collect()
    assert [(r.seq, r.date, r.nswprice, r.label) for r in got] == [(i, float(i), i + 0.5, bool(i % 3)) for i in range(n)]
    (tmp_path / "y" / "part-9.txt").write_text("UP\n")
    with pytest.raises(Exception, match="number of lines"):
        FS.read_stream_files(spark, str(tmp_path / "x"), str(tmp_path / "y")).collect()
    with pytest.raises(Exception, match="number of lines"):  # also if the label isn't read
        FS.read_stream_files(spark, str(tmp_path / "x"), str(tmp_path / "y")).select("seq", "nswprice").count()


def test_labelled_numbers_and_keep_existing(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("u\ttarget\n1\t1.0\n2\t0.0\n3\tTRUE\n4\t2\n")
    got = FS.read_labelled(spark, str(tmp_path / "a.tsv")).orderBy("row_id").collect()
    assert [r.label for r in got] == ["true", "false", "true", "false"]
    path = str(tmp_path / "t")
    FS.write_table(spark.range(3), path)
    FS.write_table(spark.range(9), path)
    assert spark.read.parquet(path).count() == 3
    FS.write_table(spark.range(9), path, if_absent=False)
    assert spark.read.parquet(path).count() == 9


def clusters(n=30, seed=1):
    rng = np.random.default_rng(seed)
    centre = np.array([[0, 0], [6, 0], [0, 6]], float)
    y = np.repeat(np.array(["a", "b", "c"]), n)
    return np.repeat(centre, n, 0) + rng.normal(0, 0.4, (3 * n, 2)), y


def test_svm_of_three_classes(spark):
    x, y = clusters()
    m = DualSVM("linear", C=10.0).fit(x, y)
    assert (m.predict(x) == y).all() and len(m.support()) > 0
    with pytest.raises(ValueError):
        m.decision(x)
    d = spark.createDataFrame([(i, x[i].tolist(), y[i]) for i in range(len(y))], "row_id long, features array<double>, label string")
    pred = {r.row_id: r.predicted for r in local_svm_predictions(d, d, 20, C=10.0).collect()}
    assert np.mean([pred[i] == y[i] for i in range(len(y))]) == 1.0


def test_support_rows_of_three_classes(spark):
    x, y = clusters()
    d = spark.createDataFrame([(i, x[i].tolist(), y[i]) for i in range(len(y))], "row_id long, features array<double>, label string")
    model = MD.svm(d, "linear", C=1.0)
    n = MD.svm_support_rows(model, d).count()
    assert 1 <= n < len(y)


def test_adam_network_learns_and_stops(spark):
    x, y = clusters()
    d = spark.createDataFrame([(i, x[i].tolist(), y[i]) for i in range(len(y))], "row_id long, features array<double>, label string")
    net = MD.train_network(d, [4], max_epochs=15, learning_rate=0.3)
    assert len(net.history["train"]) == 16 and net.history["train"][-1] < 0.8 * net.history["train"][0]


def test_cascade_reaches_the_units_asked_for(spark):
    x, y = clusters(10)
    d = spark.createDataFrame([(i, x[i].tolist(), y[i]) for i in range(len(y))], "row_id long, features array<double>, label string")
    net = MD.cascade_network(d, 2, epochs_per_stage=1, learning_rate=0.1, min_change=0.0)
    assert len(net.acts) == 2 and len(net.history["train"]) == 1 + 1 * 4  # first stage, unit 1, unit 2 alone, unit 2 with all
    early = MD.cascade_network(d, 1, epochs_per_stage=5, learning_rate=0.0, window=2, min_change=0.5)
    assert len(early.acts) == 1 and len(early.history["train"]) == 1 + 2 * 2  # stages end early, units are still added


def test_components_are_uncorrelated(spark):
    x, y = clusters()
    d = spark.createDataFrame([(i, x[i].tolist(), y[i]) for i in range(len(y))], "row_id long, features array<double>, label string")
    p = RD.fastica_fit(d, 2)
    z = (x - p.centre) @ p.w
    assert np.allclose(z.mean(0), 0, atol=1e-9) and abs(np.corrcoef(z.T)[0, 1]) < 1e-6
