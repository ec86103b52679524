"""Descriptive statistics and matrix aggregates.

Per-feature statistics use ``posexplode`` + ``groupBy(pos)`` (map-side
combine leaves d groups per task).  Gram / covariance matrices are summed
from per-partition numpy partials (``mapInPandas`` emits d^2 rows per task),
so no task ever holds more than one partition of rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.neighbors_shared import stack_vectors


def dataset_summary(df: DataFrame, features: str = "features", label: str = "label",
                    group: str | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.max(F.size(features)).cast("bigint").alias("n_features"),
            F.count_distinct(label).alias("n_classes")]
    if group:
        aggs.append(F.count_distinct(group).alias("n_groups"))
    return df.agg(*aggs)


def class_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def histogram(long_df: DataFrame, bins: int = 20) -> DataFrame:
    """Equal-width bins over [min, max] per feature; the max value goes to
    the last bin (right edge closed)."""
    st = long_df.groupBy("feature").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    j = long_df.join(F.broadcast(st), "feature")  # a row a feature: a few features must not be few tasks
    w = F.col("hi") - F.col("lo")
    b = F.when(w == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) / w * bins), F.lit(bins - 1))).cast("bigint")
    return j.groupBy("feature", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def five_number(long_df: DataFrame, exact: bool = True, probs=(0.25, 0.5, 0.75),
                n_buckets: int | None = None) -> DataFrame:
    """min, q1, median, q3, max per feature, quantiles with linear
    interpolation between order statistics (the usual 'type 7').

    Exact without holding a feature's values in one task (Spark's exact
    ``percentile`` keeps every distinct value of a group): rows are bucketed
    by literal approximate-quantile bounds; one aggregate gives each bucket's
    count/min/max; the bucket offsets locate the <= 2 * len(probs) buckets
    per feature that hold the wanted order statistics, and only the rows of
    those buckets are ranked (a distributed selection, not a sort of all
    rows).  ``exact=False`` uses ``percentile_approx`` sketches."""
    from foldwise.operators.ranking import _bucket_expr
    from foldwise.operators.sequence import default_buckets
    if not exact:
        long_df = long_df.where(F.col("x").isNotNull() & ~F.isnan(F.col("x").cast("double")))
        a = long_df.groupBy("feature").agg(F.min("x").alias("min"), F.max("x").alias("max"),
                                           F.percentile_approx("x", list(probs), 10000).alias("q"))
        return a.select("feature", "min", *[F.col("q")[i].alias(n) for i, n in enumerate(["q1", "median", "q3"])],
                        "max")
    nb = n_buckets or 4 * default_buckets(long_df)
    # missing values have no rank
    long_df = long_df.select("feature", F.col("x").cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    d = long_df.withColumn("_b", _bucket_expr(long_df, "feature", "x", nb))
    per_b = d.groupBy("feature", "_b").agg(F.count(F.lit(1)).alias("c"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    w = Window.partitionBy("feature").orderBy("_b")
    offs = per_b.withColumn("off", F.coalesce(F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    stats = per_b.groupBy("feature").agg(F.min("lo").alias("min"), F.max("hi").alias("max"), F.sum("c").alias("n"))
    want = stats.select("feature", "n", F.inline(F.array(*[F.struct(F.lit(i).alias("qi"), F.lit(float(p)).alias("p"))
                                                         for i, p in enumerate(probs)])))
    want = want.select("feature", "qi", ((F.col("n") - 1) * F.col("p")).alias("h"))
    want = want.select("feature", "qi", "h",
                       F.explode(F.array(F.floor("h").cast("bigint"), F.ceil("h").cast("bigint"))).alias("_pos"))
    # bucket holding each wanted position (small x small tables)
    loc = want.join(offs.select("feature", "_b", "off", "c"), "feature") \
        .where((F.col("_pos") >= F.col("off")) & (F.col("_pos") < F.col("off") + F.col("c")))
    need = loc.select("feature", "_b", "off").distinct()
    # one row per distinct value of the needed buckets, so a value that many rows share is one row
    values = d.join(need, ["feature", "_b"]).groupBy("feature", "_b", "off", "x").agg(F.count(F.lit(1)).alias("m"))
    before = F.coalesce(F.sum("m").over(Window.partitionBy("feature", "_b").orderBy("x")
                                        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    values = values.withColumn("_from", F.col("off") + before)
    picked = values.join(loc.select("feature", "_b", "qi", "h", "_pos"), ["feature", "_b"]) \
        .where((F.col("_pos") >= F.col("_from")) & (F.col("_pos") < F.col("_from") + F.col("m")))
    lo_hi = picked.groupBy("feature", "qi", "h").agg(F.min_by("x", "_pos").alias("xlo"), F.max_by("x", "_pos").alias("xhi"))
    q = lo_hi.select("feature", "qi", (F.col("xlo") + (F.col("h") - F.floor("h")) * (F.col("xhi") - F.col("xlo"))).alias("v"))
    wide = q.groupBy("feature").pivot("qi", list(range(len(probs)))).agg(F.first("v"))
    names = ["q1", "median", "q3"]
    return stats.join(wide, "feature").select("feature", "min", *[F.col(str(i)).alias(names[i]) for i in range(len(probs))],
                                              "max")


def first_per_class(df: DataFrame, label: str = "label", order: str = "row_id") -> DataFrame:
    """The first row (smallest ``order``) of every class."""
    rest = [c for c in df.columns if c != label]
    return (df.groupBy(label).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_first"))
            .select(label, "_first.*"))


def mean_template(df: DataFrame, features: str = "features", label: str = "label") -> DataFrame:
    """Per label, the position-wise mean vector (long form)."""
    return (df.select(label, F.posexplode(features).alias("pos", "x"))
            .groupBy(label, "pos").agg(F.avg("x").alias("mean")))


def _gram_partials(df: DataFrame, features: str, d: int, centre: list[float] | None,
                   plus_minus: bool) -> DataFrame:
    mu = np.asarray(centre, dtype=np.float64) if centre is not None else None

    def part(it):
        acc = np.zeros((d, d))
        n = 0
        for pdf in it:
            if len(pdf) == 0:
                continue
            x = stack_vectors(pdf[features], d)
            if plus_minus:
                x = np.where(x >= 0, 1.0, -1.0)
            if mu is not None:
                x = x - mu
            acc += x.T @ x
            n += len(pdf)
        if n:
            ii, jj = np.meshgrid(np.arange(d), np.arange(d), indexing="ij")
            yield pd.DataFrame({"i": ii.ravel().astype(np.int32), "j": jj.ravel().astype(np.int32),
                                "s": acc.ravel(), "n": np.full(d * d, n, dtype=np.int64)})

    return df.select(features).mapInPandas(part, "i int, j int, s double, n long")


def gram(df: DataFrame, d: int, features: str = "features", plus_minus: bool = False) -> DataFrame:
    """Sum of x x^T over rows as ``(i, j, s, n)``."""
    p = _gram_partials(df, features, d, None, plus_minus)
    return p.groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def hebbian_weights(patterns: DataFrame, d: int, features: str = "features",
                    boolean: bool = True) -> DataFrame:
    """W = X^T X / N with zero diagonal; Boolean patterns (x >= 0 here
    when ``boolean``) are mapped to +-1 first.  Long form ``(i, j, w)``."""
    g = gram(patterns, d, features, plus_minus=boolean)
    return g.select("i", "j", F.when(F.col("i") == F.col("j"), F.lit(0.0))
                    .otherwise(F.col("s") / F.col("n")).alias("w"))


def column_means(df: DataFrame, features: str = "features") -> list[float]:
    rows = (df.select(F.posexplode(features).alias("pos", "x")).groupBy("pos")
            .agg(F.avg("x").alias("m")).orderBy("pos").collect())
    return [r["m"] for r in rows]


def covariance(df: DataFrame, d: int, features: str = "features", means: list[float] | None = None) -> DataFrame:
    """Sample covariance (n - 1) of centred rows, ``(i, j, cov)``."""
    means = means if means is not None else column_means(df, features)
    p = _gram_partials(df, features, d, means, False)
    g = p.groupBy("i", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return g.select("i", "j", (F.col("s") / (F.col("n") - 1)).alias("cov"))


def correlation_matrix(long_df: DataFrame, id_col: str = "row_id") -> DataFrame:
    """Pearson r for every pair of the given (few) features; NULL for a
    constant feature.  Pairs are formed per row (d^2 per row, d small)."""
    a = long_df.select(id_col, F.col("feature").alias("fi"), F.col("x").alias("xi"))
    b = long_df.select(id_col, F.col("feature").alias("fj"), F.col("x").alias("xj"))
    p = a.join(b, id_col)
    agg = p.groupBy("fi", "fj").agg(F.covar_pop("xi", "xj").alias("c"), F.stddev_pop("xi").alias("si"),
                                    F.stddev_pop("xj").alias("sj"))
    den = F.col("si") * F.col("sj")
    return agg.select("fi", "fj", F.when(den == 0, F.lit(None).cast("double")).otherwise(F.col("c") / den).alias("r"))


def correlation_from_vectors(df: DataFrame, d: int, features: str = "features") -> DataFrame:
    """D5 for vectors: r_ij = cov_ij / sqrt(cov_ii cov_jj) from the centred
    Gram partials (d^2 rows per task, no per-row pairs); NULL when a feature
    is constant."""
    cov = covariance(df, d, features)
    diag = cov.where(F.col("i") == F.col("j")).select(F.col("i").alias("k"), F.col("cov").alias("v"))
    j = (cov.join(diag.withColumnRenamed("k", "i").withColumnRenamed("v", "vi"), "i")
         .join(diag.withColumnRenamed("k", "j").withColumnRenamed("v", "vj"), "j"))
    den = F.sqrt(F.col("vi") * F.col("vj"))
    return j.select("i", "j", F.when(den == 0, F.lit(None).cast("double")).otherwise(F.col("cov") / den).alias("r"))
