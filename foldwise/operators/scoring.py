"""Supervised feature scores and selection.

Input is the long form ``(row_id?, feature, x, cls)`` where ``cls`` is the
class index (1..K, or 1/0 with two classes as the reference's one-hot
column gives).  Every score is one or two aggregations keyed by feature;
Kendall avoids the N^2 pair loop with per-class running counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foldwise.functions.prep import class_list
from foldwise.operators.ranking import average_ranks, ordinal_rank, running_sum
from foldwise.session import cut_lineage

# Keep-rules of the reference's filter experiments.
KEEP_RULES = {"kendall": ("min", 0.3), "anova": ("min", 0.3), "pearson": ("abs", 0.1),
              "spearman": ("min", 0.01)}


def class_index(col: str | Column, classes: list) -> Column:
    """Class position as the reference's targets: 1..K for K > 2 classes;
    with <= 2 classes one one-hot column, so 1 for classes[0] else 0."""
    c = F.col(col) if isinstance(col, str) else col
    if len(classes) <= 2:
        return F.when(c == F.lit(classes[0]), F.lit(1)).otherwise(F.lit(0))
    idx = F.lit(0)
    for i, v in enumerate(classes):
        idx = F.when(c == F.lit(v), F.lit(i + 1)).otherwise(idx)
    return idx


def to_long(df: DataFrame, feature_cols: list[str], label: str, classes: list | None = None,
            id_col: str | None = None) -> DataFrame:
    """Wide numeric columns -> ``(row_id, feature, x, cls)``."""
    classes = classes if classes is not None else class_list(df, label)
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in feature_cols)
    ids = [F.col(id_col).alias("row_id")] if id_col else []
    base = df.select(*ids, class_index(label, classes).alias("cls"), *feature_cols)
    return base.selectExpr(*(["row_id"] if id_col else []), "cls",
                           f"stack({len(feature_cols)}, {stack}) AS (feature, x)")


def vector_to_long(df: DataFrame, features: str = "features", label: str = "label",
                   classes: list | None = None, id_col: str = "row_id") -> DataFrame:
    classes = classes if classes is not None else class_list(df, label)
    return df.select(F.col(id_col).alias("row_id"), class_index(label, classes).alias("cls"),
                     F.posexplode(features).alias("pos", "x")) \
        .select("row_id", "cls", F.concat(F.lit("x"), (F.col("pos") + 1).cast("string")).alias("feature"), "x")


def valued(long_df: DataFrame, y: str = "cls") -> DataFrame:
    """Rows that a score counts: those with a value (neither NULL nor NaN) and a class. Each feature is scored
    over its own rows; a feature without any has no score row, which ``prune_columns`` treats as not kept."""
    return long_df.where(F.col("x").isNotNull() & ~F.isnan(F.col("x").cast("double")) & F.col(y).isNotNull())


def kendall_score(long_df: DataFrame, max_classes: int = 10_000) -> DataFrame:
    """(concordant - other pairs) / (N^2 / 2) per feature; a pair is
    concordant when x and class order agree strictly, ties count as -1.
    concordant = sum over hi-class rows of the lo-class rows (lo < hi) with a
    strictly smaller value.  One plan column per class: more than
    ``max_classes`` classes are an error.  Rows without a value or class don't count."""
    long_df = valued(long_df)
    classes = long_df.select("cls").distinct()
    cls_vals = sorted(r[0] for r in classes.limit(max_classes + 1).collect())
    if len(cls_vals) > max_classes:
        raise ValueError("too many classes")
    # one row per (feature, value) with the count of every class
    ns = [f"_n{i}" for i in range(len(cls_vals))]
    per_value = long_df.groupBy("feature", "x").agg(
        *[F.count_if(F.col("cls") == c).alias(n) for c, n in zip(cls_vals, ns)])
    # read by the bound sampling, the bucket totals and the running sums:
    # materialise the (usually much smaller) count table once
    per_value = cut_lineage(per_value)
    below = [f"_b{i}" for i in range(len(cls_vals))]
    run = running_sum(per_value, ["feature"], "x", ns, below)
    # rows of class i at this value pair with lower-class rows at smaller values
    # doubles: pair counts pass the BIGINT range at some 10^9 rows
    terms = [F.col(ns[i]).cast("double") * sum((F.col(below[j]) for j in range(i)), F.lit(0)) for i in range(1, len(ns))]
    conc = run.groupBy("feature").agg(F.sum(sum(terms, F.lit(0))).alias("concordant"),
                                      F.sum(sum((F.col(n) for n in ns), F.lit(0))).alias("n_rows"))
    n = F.col("n_rows").cast("double")
    pairs = n * (n - 1) / 2
    return conc.select("feature", ((2 * F.col("concordant") - pairs) / (0.5 * n * n)).alias("score"))


def anova_ratio(long_df: DataFrame) -> DataFrame:
    """sum_c n_c (mean_c - mean)^2 / sum_c sum (x - mean_c)^2 (no degrees of
    freedom); 0/0 -> NULL.  Rows without a value or class don't count."""
    per = valued(long_df).groupBy("feature", "cls").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("m"),
                                                 F.var_pop("x").alias("v"))
    w = Window.partitionBy("feature")  # one row per class: the grand mean needs no second scan
    j = per.withColumn("mu", F.sum(F.col("n") * F.col("m")).over(w) / F.sum("n").over(w))
    agg = j.groupBy("feature").agg(F.sum(F.col("n") * (F.col("m") - F.col("mu")) ** 2).alias("ssb"),
                                   F.sum(F.col("n") * F.col("v")).alias("ssw"))
    return agg.select("feature", F.when(F.col("ssw") == 0, F.lit(None).cast("double"))
                      .otherwise(F.col("ssb") / F.col("ssw")).alias("score"))


def pearson_score(long_df: DataFrame, y: str = "cls") -> DataFrame:
    """r(x, y) per feature; NULL for a constant column.  Rows without a value or ``y`` don't count."""
    agg = valued(long_df, y).groupBy("feature").agg(F.covar_pop("x", F.col(y).cast("double")).alias("c"),
                                         F.stddev_pop("x").alias("sx"),
                                         F.stddev_pop(F.col(y).cast("double")).alias("sy"))
    den = F.col("sx") * F.col("sy")
    return agg.select("feature", F.when(den == 0, F.lit(None).cast("double"))
                      .otherwise(F.col("c") / den).alias("score"))


def spearman_score(long_df: DataFrame, ties: str = "order") -> DataFrame:
    """Pearson of the ranks of x and of the class.  ``ties='order'``: equal values are ranked by row position;
    ``'average'``: they share their mean rank.  Rows without a value or class don't count."""
    if ties not in ("order", "average"):
        raise ValueError("ties must be 'order' or 'average'")
    long_df = valued(long_df)
    if ties == "order":
        rx = ordinal_rank(long_df, "feature", "x", "row_id", out="rx")
        ry = ordinal_rank(rx, "feature", "cls", "row_id", out="ry")
        return pearson_score(ry.select("feature", F.col("rx").cast("double").alias("x"),
                                       F.col("ry").alias("ry")), y="ry")
    # one row per (feature, value, class): a tie is one row from here on
    cells = cut_lineage(long_df.groupBy("feature", "x", "cls").agg(F.count(F.lit(1)).alias("n")))
    rx = average_ranks(cells.groupBy("feature", "x").agg(F.sum("n").alias("n")), "feature", "x", out="rx")
    by_class = cells.groupBy("feature", "cls").agg(F.sum("n").alias("n"))  # features x classes rows
    before = Window.partitionBy("feature").orderBy("cls").rowsBetween(Window.unboundedPreceding, -1)
    ry = by_class.select("feature", "cls", (F.coalesce(F.sum("n").over(before), F.lit(0)) + (F.col("n") + 1) / 2).alias("ry"),
                         ((F.sum("n").over(Window.partitionBy("feature")) + 1) / 2).alias("mid"))
    c = cells.join(rx, ["feature", "x"]).join(ry, ["feature", "cls"])
    dx, dy = F.col("rx") - F.col("mid"), F.col("ry") - F.col("mid")
    agg = c.groupBy("feature").agg(F.sum(F.col("n") * dx * dy).alias("c"), F.sum(F.col("n") * dx * dx).alias("vx"), F.sum(F.col("n") * dy * dy).alias("vy"))
    den = F.sqrt("vx") * F.sqrt("vy")
    return agg.select("feature", F.when(den == 0, F.lit(None).cast("double")).otherwise(F.col("c") / den).alias("score"))


def mutual_information(long_df: DataFrame, bins: int = 10) -> DataFrame:
    """MI (nats) of the class and the feature cut into ``bins`` equal-width
    bins over [min, max] (max goes to the last bin)."""
    st = long_df.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    j = long_df.join(F.broadcast(st), "feature")  # a row a feature: a few features must not be few tasks
    width = F.col("hi") - F.col("lo")
    b = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / width * bins), F.lit(bins - 1))).cast("int")
    cells = j.groupBy("feature", b.alias("bin"), "cls").agg(F.count(F.lit(1)).alias("n"))
    wf = Window.partitionBy("feature")
    cells = (cells.withColumn("n_all", F.sum("n").over(wf))
             .withColumn("nb", F.sum("n").over(Window.partitionBy("feature", "bin")))
             .withColumn("nc", F.sum("n").over(Window.partitionBy("feature", "cls"))))
    term = (F.col("n") / F.col("n_all")) * F.log((F.col("n") * F.col("n_all")) / (F.col("nb") * F.col("nc")))
    return cells.groupBy("feature").agg(F.sum(term).alias("score"))


def prune_columns(scores: DataFrame, method: str) -> DataFrame:
    """Features whose score passes the method's rule."""
    kind, t = KEEP_RULES[method]
    s = F.col("score")
    cond = (F.abs(s) >= t) if kind == "abs" else (s >= t)
    return scores.where(s.isNotNull() & cond).select("feature")


def rfe_logistic(df: DataFrame, feature_cols: list[str], label: str, keep: int,
                 max_iter: int = 50) -> list[str]:
    """Repeatedly fit a multinomial logistic model on standardised
    features and drop the half with the smallest sum of |coef| until
    ``keep`` remain.  Returns the surviving feature names.  A missing value is
    an error (impute first): no row is dropped."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
    current = list(feature_cols)
    idx = StringIndexer(inputCol=label, outputCol="_y").fit(df)
    base = idx.transform(df)
    while len(current) > keep:
        va = VectorAssembler(inputCols=current, outputCol="_raw", handleInvalid="error").transform(base)
        sc = StandardScaler(inputCol="_raw", outputCol="_f", withMean=True, withStd=True).fit(va).transform(va)
        m = LogisticRegression(featuresCol="_f", labelCol="_y", maxIter=max_iter,
                               family="multinomial").fit(sc)
        coef = m.coefficientMatrix.toArray()
        weight = abs(coef).sum(axis=0)
        n_next = max(keep, len(current) // 2)
        order = sorted(range(len(current)), key=lambda i: (-weight[i], i))[:n_next]
        current = [current[i] for i in sorted(order)]
    return current
