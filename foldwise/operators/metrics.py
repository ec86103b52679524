"""Accuracy and confusion-matrix metrics.

Everything starts from one ``groupBy(group..., actual, predicted).count()``
over the prediction table (map-side combined; K^2 rows per group survive the
shuffle).  Per-class and summary metrics are derived from that small table;
the prediction table is never rescanned per class.

Rules (fixed by the reference's definitions):
  * rows of the matrix = actual class, columns = predicted class;
  * recall, specificity, precision (PPV), NPV are 1 when their denominator
    is 0; F1 is 0 when recall = precision = 0;
  * with <= 2 classes the metrics are those of the first class (one
    one-hot column); with more, per-class metrics are combined weighted by
    the class's actual count (default) or by a plain mean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.functions.common import ratio

METRICS = ["accuracy", "error_rate", "recall", "specificity", "precision", "npv", "f1"]


def accuracy(df: DataFrame, actual: str, predicted: str, group_cols=()) -> DataFrame:
    """mean(actual == predicted) per group."""
    return df.groupBy(*group_cols).agg(
        F.avg((F.col(actual) == F.col(predicted)).cast("double")).alias("accuracy"))


def accuracy_onehot(df: DataFrame, actual_arr: str, predicted_arr: str, group_cols=()) -> DataFrame:
    """One-hot rows count as right only when every column agrees."""
    return df.groupBy(*group_cols).agg(
        F.avg((F.col(actual_arr) == F.col(predicted_arr)).cast("double")).alias("accuracy"))


def _binary_from_cells(tp: Column, fn: Column, fp: Column, tn: Column) -> list[Column]:
    n = tp + fn + fp + tn
    acc = ratio(tp + tn, n, 0.0)
    recall = ratio(tp, tp + fn, 1.0)
    spec = ratio(tn, tn + fp, 1.0)
    ppv = ratio(tp, tp + fp, 1.0)
    npv = ratio(tn, tn + fn, 1.0)
    f1 = F.when((recall == 0) & (ppv == 0), F.lit(0.0)).otherwise(2 * recall * ppv / (recall + ppv))
    return [acc.alias("accuracy"), (1 - acc).alias("error_rate"), recall.alias("recall"),
            spec.alias("specificity"), ppv.alias("precision"), npv.alias("npv"), f1.alias("f1")]


def confusion_binary(df: DataFrame, actual: str, predicted: str | Column, group_cols=(),
                     threshold: float | None = None) -> DataFrame:
    """Actual BOOLEAN against predicted BOOLEAN (or a score and a threshold)."""
    p = F.col(predicted) if isinstance(predicted, str) else predicted
    if threshold is not None:
        p = p >= F.lit(threshold)
    a = F.col(actual)
    cells = df.groupBy(*group_cols).agg(
        F.count_if(~a & ~p).alias("tn"), F.count_if(~a & p).alias("fp"),
        F.count_if(a & ~p).alias("fn"), F.count_if(a & p).alias("tp"))
    return cells.select(*group_cols, "tn", "fp", "fn", "tp",
                        *_binary_from_cells(F.col("tp"), F.col("fn"), F.col("fp"), F.col("tn")))


def confusion_counts(df: DataFrame, actual: str, predicted: str, group_cols=()) -> DataFrame:
    return (df.groupBy(*group_cols, F.col(actual).alias("actual"), F.col(predicted).alias("predicted"))
            .agg(F.count(F.lit(1)).alias("n")))


def classes_from_counts(counts: DataFrame, group_cols=()) -> DataFrame:
    """Default class list per group: union of actual and predicted values."""
    c = (counts.select(*group_cols, F.col("actual").alias("class"))
         .unionByName(counts.select(*group_cols, F.col("predicted").alias("class"))).distinct())
    return c.withColumn("class_idx", (F.row_number().over(
        Window.partitionBy(*group_cols).orderBy("class")) - 1).cast("int"))


def classes_for_groups(counts: DataFrame, classes: list, group_cols) -> DataFrame:
    """One shared class list (a collected, bounded Python list) laid out for
    every group by exploding a literal array: no join."""
    lit = F.array(*[F.struct(F.lit(c).cast("string").alias("class"), F.lit(i).alias("class_idx"))
                    for i, c in enumerate(classes)])
    return (counts.select(*group_cols).distinct()
            .select(*group_cols, F.inline(lit)))


def _with_group(counts: DataFrame, group_cols):
    g = list(group_cols)
    if g:
        return counts, g, False
    return counts.withColumn("_g", F.lit(0)), ["_g"], True


def per_class_cells(counts: DataFrame, classes: DataFrame, g: list) -> DataFrame:
    """tp / fn / fp / tn of every class in ONE pass over the counts: each
    cell (a, p, n) adds n to row a (and to tp when a = p) and to column p."""
    contrib = F.explode(F.array(
        F.struct(F.col("actual").alias("class"), F.col("n").alias("na"), F.lit(0).cast("bigint").alias("np"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).cast("bigint").alias("tp")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).cast("bigint").alias("na"), F.col("n").alias("np"),
                 F.lit(0).cast("bigint").alias("tp"))))
    per = (counts.select(*g, contrib.alias("c")).select(*g, "c.*")
           .groupBy(*g, "class").agg(F.sum("na").alias("n_actual"), F.sum("np").alias("n_pred"),
                                      F.sum("tp").alias("tp")))
    cells = classes.join(per, [*g, "class"], "left")
    z = F.lit(0)
    cells = cells.select(*g, "class", "class_idx",
                         F.coalesce("tp", z).alias("tp"), F.coalesce("n_actual", z).alias("n_actual"),
                         F.coalesce("n_pred", z).alias("n_pred"))
    # group total: classes per group are few, the window is over that small table
    cells = cells.withColumn("total", F.sum("n_actual").over(Window.partitionBy(*g)))
    return cells.select(*g, "class", "class_idx", "tp", "n_actual", "total",
                        (F.col("n_actual") - F.col("tp")).alias("fn"),
                        (F.col("n_pred") - F.col("tp")).alias("fp"),
                        (F.col("total") - F.col("n_actual") - F.col("n_pred") + F.col("tp")).alias("tn"))


def multiclass_metrics(counts: DataFrame, classes: list | None = None, group_cols=(),
                       weighted: bool = True) -> DataFrame:
    """D9/D10 from a ``(group..., actual, predicted, n)`` table.  ``classes``
    is one class list shared by every group (e.g. all labels of the data set
    in cross-validation); default: per group, actual union predicted."""
    counts, g, dummy = _with_group(counts, group_cols)
    cls = classes_from_counts(counts, g) if classes is None else classes_for_groups(counts, classes, g)
    cells = per_class_cells(counts, cls, g)
    m = cells.select(*g, "class_idx", "tp", "n_actual", "total",
                     *_binary_from_cells(F.col("tp"), F.col("fn"), F.col("fp"), F.col("tn"))[2:])
    w = ratio(F.col("n_actual"), F.col("total"), 0.0)
    names = ["recall", "specificity", "precision", "npv", "f1"]
    aggs = [F.count(F.lit(1)).alias("n_classes"), F.first("total").alias("n"),
            F.sum("tp").alias("n_right")]
    for c in names:
        comb = F.sum(w * F.col(c)) if weighted else F.avg(c)
        aggs += [comb.alias(c + "_multi"), F.min_by(c, "class_idx").alias(c + "_first")]
    out = m.groupBy(*g).agg(*aggs)
    acc = ratio(F.col("n_right"), F.col("n"), 0.0)
    cols = [F.col("n").cast("bigint").alias("n"), acc.alias("accuracy"), (1 - acc).alias("error_rate")]
    for c in names:
        cols.append(F.when(F.col("n_classes") <= 2, F.col(c + "_first"))
                    .otherwise(F.col(c + "_multi")).alias(c))
    res = out.select(*g, *cols)
    return res.drop("_g") if dummy else res


def confusion_matrix(counts: DataFrame, classes: list, group_cols=()) -> DataFrame:
    """K x K cells (zeros included), long format, for one shared class list."""
    counts, g, dummy = _with_group(counts, group_cols)
    pairs = F.array(*[F.struct(F.lit(a).cast("string").alias("actual"), F.lit(p).cast("string").alias("predicted"))
                      for a in classes for p in classes])
    grid = counts.select(*g).distinct().select(*g, F.inline(pairs))
    res = (grid.join(counts, [*g, "actual", "predicted"], "left")
           .select(*g, "actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))
    return res.drop("_g") if dummy else res


def confusion_labels(df: DataFrame, actual: str, predicted: str, classes: list | None = None,
                     group_cols=(), weighted: bool = True) -> DataFrame:
    counts = confusion_counts(df, actual, predicted, group_cols)
    return multiclass_metrics(counts, classes, group_cols, weighted)


def confusion_report(metrics: DataFrame, group_cols=()) -> DataFrame:
    """Metrics row(s) -> tidy ``(group..., metric, value)``."""
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in METRICS)
    return metrics.selectExpr(*[f"`{c}`" for c in group_cols], f"stack({len(METRICS)}, {stack}) AS (metric, value)")


def fold_summary(fold_metrics: DataFrame, group_cols=()) -> DataFrame:
    """Mean and sample std over folds of every metric."""
    aggs = [F.count(F.lit(1)).alias("n_folds")]
    for m in METRICS:
        aggs += [F.avg(m).alias(m + "_mean"), F.stddev_samp(m).alias(m + "_std")]
    return fold_metrics.groupBy(*group_cols).agg(*aggs)


def summed_matrix(fold_counts: DataFrame, group_cols=()) -> DataFrame:
    """Confusion matrices summed over folds."""
    return fold_counts.groupBy(*group_cols, "actual", "predicted").agg(F.sum("n").cast("bigint").alias("n"))


def repetition_mean(rep_metrics: DataFrame, fold: str = "fold", group_cols=()) -> DataFrame:
    """Mean over repetitions inside each fold, then D15 across folds."""
    per_fold = rep_metrics.groupBy(*group_cols, fold).agg(*[F.avg(m).alias(m) for m in METRICS])
    return fold_summary(per_fold, group_cols)
