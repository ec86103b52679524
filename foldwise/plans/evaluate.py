"""Evaluation drivers (V1-V8): cross-validation, repeated CV, sweeps,
train/test evaluation and comparisons.

Cross-validation builds ONE prediction table ``(row_id, fold, actual,
predicted)`` for all folds, then one confusion group-by gives every fold's
matrix; metrics, means and standard deviations come from that small table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.common import rnd
from foldwise.functions.prep import class_list
from foldwise.operators import metrics as M
from foldwise.operators.neighbors import knn_cross_validate_predictions
from foldwise.session import cut_lineage


@dataclass
class CVResult:
    predictions: DataFrame   # row_id, fold, actual, predicted
    fold_metrics: DataFrame  # fold, n, accuracy, ... f1
    summary: DataFrame       # n_folds, <metric>_mean, <metric>_std
    matrix: DataFrame        # actual, predicted, n (summed over folds)


def evaluate_predictions(pred: DataFrame, classes: list, fold: str = "fold",
                         weighted: bool = True, group_cols=()) -> CVResult:
    g = list(group_cols)
    # (groups x folds x K^2) rows, reused by metrics and matrix: keep it
    counts = M.confusion_counts(pred, "actual", "predicted", [*g, fold]).persist()
    fm = M.multiclass_metrics(counts, classes, [*g, fold], weighted)
    return CVResult(pred, fm, M.fold_summary(fm, g),
                    M.summed_matrix(M.confusion_matrix(counts, classes, [*g, fold]), g))


def knn_cross_validate(df: DataFrame, k: int, fold: str = "fold", label: str = "label",
                       classes: list | None = None, weighted: bool = True,
                       scale: str | None = None, lsh: dict | None = None, block_rows: int | None = None) -> CVResult:
    """V1 for kNN: every fold predicted from the other folds in one pass;
    ``scale='per_fold'`` fits min-max on each fold's training rows."""
    classes = classes if classes is not None else class_list(df, label)
    # one plan reads this table on both sides of the block join and for the
    # label join-back; identical subtrees share their exchanges, so it is not
    # materialised (a rewrite of the whole feature table costs more)
    df = df.select("row_id", "features", F.col(label).cast("string").alias(label), fold)
    pred = knn_cross_validate_predictions(df, k, fold, label, scale=scale, lsh=lsh, **({"block_rows": block_rows} if block_rows else {}))
    return evaluate_predictions(pred, [str(c) for c in classes], fold, weighted)


def rounded_summary(summary: DataFrame, keep=()) -> DataFrame:
    cols = [F.col(c) for c in keep] + [F.col("n_folds").cast("bigint").alias("n_folds")]
    for m in M.METRICS:
        cols += [rnd(m + "_mean").alias(m + "_mean"), rnd(m + "_std").alias(m + "_std")]
    return summary.select(*cols)


# ------------------------------------------------------------ generic drivers
def cross_validate(df: DataFrame, fit, fold: str = "fold", label: str = "label",
                   classes: list | None = None, weighted: bool = True, id_col: str = "row_id",
                   prepare=None) -> CVResult:
    """V1: for every fold, ``fit(train) -> model`` with ``model.predict``;
    the k prediction tables are stacked into ONE table before the metrics.
    ``prepare(train, test) -> (train, test)`` fits preprocessing (scaling,
    filters, PCA) on the training rows of each fold only."""
    classes = [str(c) for c in (classes if classes is not None else class_list(df, label))]
    # the folds are read k times (and by iterative fits): materialise once
    # in the shared checkpoint folder instead of recomputing the lineage
    df = cut_lineage(df)
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())
    preds = None
    for f in folds:
        train, test = df.where(F.col(fold) != f), df.where(F.col(fold) == f)
        if prepare is not None:
            train, test = prepare(train, test)
        model = fit(train)
        p = (model.predict(test, id_col).join(test.select(id_col, F.col(label).cast("string").alias("actual")), id_col)
             .withColumn(fold, F.lit(f)))
        preds = p if preds is None else preds.unionByName(p)
    return evaluate_predictions(preds, classes, fold, weighted)


def cross_validate_repeated(df: DataFrame, fit_seeded, reps: int, fold: str = "fold", label: str = "label",
                            classes: list | None = None, id_col: str = "row_id",
                            validation_ratio: float = 0.0, seed: int = 42):
    """V2: non-deterministic models trained ``reps`` times per fold (seed =
    rep); optional inner validation split of the training rows.  Metrics are
    averaged over repetitions inside each fold, then over folds (D16)."""
    from foldwise.operators.splits import hold_out
    classes = [str(c) for c in (classes if classes is not None else class_list(df, label))]
    df = cut_lineage(df)
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())
    per = None
    for f in folds:
        train, test = df.where(F.col(fold) != f), df.where(F.col(fold) == f)
        for r in range(reps):
            val = None
            tr = train
            if validation_ratio > 0:
                s = hold_out(train, validation_ratio, seed + r, id_col)
                tr, val = s.where("split = 'train'").drop("split"), s.where("split = 'test'").drop("split")
            model = fit_seeded(tr, val, r)
            p = (model.predict(test, id_col)
                 .join(test.select(id_col, F.col(label).cast("string").alias("actual")), id_col)
                 .withColumn(fold, F.lit(f)).withColumn("rep", F.lit(r)))
            per = p if per is None else per.unionByName(p)
    counts = M.confusion_counts(per, "actual", "predicted", [fold, "rep"])
    fm = M.multiclass_metrics(counts, classes, [fold, "rep"])
    return M.repetition_mean(fm, fold)


def train_test_eval(train: DataFrame, test: DataFrame, fit, label: str = "label",
                    classes: list | None = None, id_col: str = "row_id") -> DataFrame:
    """V5: fit on train, score test, one metrics row."""
    classes = [str(c) for c in (classes if classes is not None else class_list(train, label))]
    model = fit(train)
    p = model.predict(test, id_col).join(test.select(id_col, F.col(label).cast("string").alias("actual")), id_col)
    return M.multiclass_metrics(M.confusion_counts(p, "actual", "predicted"), classes)


def sweep(df: DataFrame, configs: list[tuple[str, dict]], make_fit, fold: str = "fold",
          label: str = "label", classes: list | None = None) -> DataFrame:
    """V3: cross-validate every (model, params) pair; a failing config is
    kept as a row with its error text.  Only metric rows reach the driver."""
    spark = df.sparkSession
    classes = classes if classes is not None else class_list(df, label)
    rows = []
    for i, (model, params) in enumerate(configs):
        try:
            res = cross_validate(df, make_fit(model, params), fold, label, classes)
            s = res.summary.first()
            rows.append((model, i, str(sorted(params.items())), float(s["accuracy_mean"]),
                         float(s["accuracy_std"] or 0.0), float(s["f1_mean"]), None))
        except Exception as e:  # noqa: BLE001 - logged and skipped, as the sweep promises
            rows.append((model, i, str(sorted(params.items())), None, None, None, f"{type(e).__name__}: {e}"[:500]))
    return spark.createDataFrame(rows, "model string, config_id int, params string, acc_mean double, "
                                       "acc_std double, f1_mean double, error string")
