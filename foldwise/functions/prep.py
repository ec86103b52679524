"""Cleaning, encoding and scaling (B operators).

Fitted scalers are small dataclasses holding parameter-sized values
(one number per feature); ``transform`` is a pure projection, so it fuses
into whole-stage codegen with whatever reads the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text spellings read as true (after trim + lower case).
TRUE_WORDS = ["1", "true", "t", "yes", "y", "up"]

# Largest class list a one-hot encoding accepts (it is collected).
MAX_CLASSES = 10_000


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    return df.drop(*cols)


def rename_features(df: DataFrame, keep: tuple[str, ...] = ("label",), prefix: str = "x") -> DataFrame:
    """Feature columns -> x1..xn (in table order), ``keep`` columns unchanged."""
    feats = [c for c in df.columns if c not in keep]
    names = {c: f"{prefix}{i + 1}" for i, c in enumerate(feats)}
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in df.columns])


def parse_bool(df: DataFrame, col: str) -> Column:
    """Numbers: x == 1; text: trimmed lower-case spelling in TRUE_WORDS."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.BooleanType):
        return F.col(col)
    if isinstance(dtype, T.NumericType):
        return F.col(col) == 1
    return F.lower(F.trim(F.col(col).cast("string"))).isin(TRUE_WORDS)


def to_float(col: str, strict: bool = True) -> Column:
    """Cast to double; strict raises on unparseable text (ANSI), otherwise
    unparseable values become NULL (``try_cast``)."""
    if strict:
        return F.col(col).cast("double")
    return F.expr(f"try_cast(`{col}` AS DOUBLE)")


def missing_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: number and percent of NULL (or NaN) values, in one pass."""
    cols = cols or df.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        cond = F.col(c).isNull()
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            cond = cond | F.isnan(F.col(c))
        aggs.append(F.count_if(cond).alias(c))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', CAST(`{c}` AS BIGINT)" for c in cols)
    long = wide.selectExpr("_n", f"stack({len(cols)}, {stack}) AS (column_name, n_missing)")
    return long.select(
        "column_name", "n_missing",
        (F.col("n_missing") * 100.0 / F.col("_n")).alias("pct_missing"),
    )


def missing_mean(profile: DataFrame) -> DataFrame:
    """The mean percentage of missing values over all profiled columns."""
    return profile.agg(F.avg("pct_missing").alias("mean_pct_missing"))


@dataclass
class MeanImputer:
    means: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(*[
            F.coalesce(F.col(c).cast("double"), F.lit(self.means[c])).alias(c)
            if c in self.means else F.col(c) for c in df.columns])


def impute_mean_fit(df: DataFrame, cols: list[str]) -> MeanImputer:
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    return MeanImputer({c: (row[c] if row[c] is not None else 0.0) for c in cols})


def impute_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                       if c in cols else F.col(c) for c in df.columns])


def class_list(df: DataFrame, col: str, max_classes: int = MAX_CLASSES) -> list:
    """Sorted distinct values; refuses to collect more than ``max_classes``."""
    vals = df.select(col).distinct().limit(max_classes + 1).collect()
    if len(vals) > max_classes:
        raise ValueError(f"{col} has more than {max_classes} distinct values")
    return sorted(v[0] for v in vals)


def one_hot(df: DataFrame, col: str, classes: list | None = None, out: str = "onehot") -> tuple[DataFrame, list]:
    """<=2 classes: one Boolean (value == classes[0]); more: one Boolean per
    class.  Returned as ``ARRAY<BOOLEAN>`` plus the class order.  A value
    outside ``classes`` raises at run time."""
    if isinstance(df.schema[col].dataType, T.BooleanType):
        return df.withColumn(out, F.array(F.col(col))), [True]
    classes = classes if classes is not None else class_list(df, col)
    lits = [F.lit(c) for c in classes]
    known = F.col(col).isin(*classes)
    if len(classes) <= 2:
        arr = F.array(F.col(col) == lits[0])
    else:
        arr = F.array(*[F.col(col) == lc for lc in lits])
    checked = F.when(known, arr).otherwise(
        F.raise_error(F.concat(F.lit(f"one_hot: unknown value in {col}: "), F.col(col).cast("string"))))
    return df.withColumn(out, checked), classes


def one_hot_decode(arr: str | Column) -> Column:
    """1-based index of the (first) true column."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.array_position(a, True).cast("bigint")


def classify_outputs(scores: str | Column, threshold: float = 0.5, multi: bool = True) -> Column:
    """Scalar score: score >= threshold.  Score vector: one-hot of the row
    maximum, the first maximum wins."""
    s = F.col(scores) if isinstance(scores, str) else scores
    if not multi:
        return s >= F.lit(threshold)
    best = F.array_position(s, F.array_max(s))
    return F.transform(s, lambda x, i: (i + 1) == best)


def binarize(pixels: str | Column, threshold: float) -> Column:
    p = F.col(pixels) if isinstance(pixels, str) else pixels
    return F.transform(p, lambda x: x >= F.lit(threshold))


def crop(pixels: str | Column, width: int, ratio_: float) -> Column:
    """Row-major images of ``width`` columns: set the last ceil(width*ratio)
    columns to false."""
    import math
    n = math.ceil(width * ratio_)
    p = F.col(pixels) if isinstance(pixels, str) else pixels
    if n <= 0:
        return p
    return F.transform(p, lambda x, i: F.when(F.pmod(i, F.lit(width)) >= width - n, F.lit(False)).otherwise(x))


# ----------------------------------------------------------------------- scalers
def _positions(df: DataFrame, features: str) -> DataFrame:
    return df.select(F.posexplode(features).alias("pos", "x"))


@dataclass
class VectorScaler:
    """Per-position (shift, scale) applied to an ``ARRAY<DOUBLE>`` column."""
    kind: str
    a: list[float]  # min or mean
    b: list[float]  # max or std

    def transform(self, df: DataFrame, features: str = "features", out: str | None = None) -> DataFrame:
        out = out or features
        a = F.array(*[F.lit(float(v)) for v in self.a])
        b = F.array(*[F.lit(float(v)) for v in self.b])
        if self.kind == "minmax":
            expr = F.transform(F.col(features), lambda x, i: F.when(b[i] == a[i], F.lit(0.0))
                               .otherwise((x - a[i]) / (b[i] - a[i])))
        else:
            expr = F.transform(F.col(features), lambda x, i: F.when(b[i] == 0, F.lit(0.0))
                               .otherwise((x - a[i]) / b[i]))
        return df.withColumn(out, expr)


def _fit_positions(df: DataFrame, features: str, aggs) -> list:
    # posexplode + groupBy(pos): map-side combine leaves d groups per task.
    rows = _positions(df, features).groupBy("pos").agg(*aggs).orderBy("pos").collect()
    return rows


def minmax_fit(df: DataFrame, features: str = "features") -> VectorScaler:
    rows = _fit_positions(df, features, [F.min("x").alias("a"), F.max("x").alias("b")])
    return VectorScaler("minmax", [r["a"] for r in rows], [r["b"] for r in rows])


def zscore_fit(df: DataFrame, features: str = "features") -> VectorScaler:
    rows = _fit_positions(df, features, [F.avg("x").alias("a"),
                                         F.coalesce(F.stddev_samp("x"), F.lit(0.0)).alias("b")])
    return VectorScaler("zscore", [r["a"] for r in rows], [r["b"] for r in rows])


# --------------------------------------------------------------- discrete / cyclic
def discrete_gap(df: DataFrame, col: str) -> DataFrame:
    """One row ``gap``: the smallest gap between sorted distinct values when
    every gap is an integer multiple of it (tolerance 1e-3), else 0.
    Consecutive distinct values are paired through ``dense_seq`` + an
    equi-join, so no single task sees all values."""
    from foldwise.operators.sequence import dense_seq
    vals = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull()).distinct()
    s = dense_seq(vals, [F.col("v")], numeric_key="v", name="s")
    nxt = s.select((F.col("s") - 1).alias("s"), F.col("v").alias("v_next"))
    d = s.join(nxt, "s").select((F.col("v_next") - F.col("v")).alias("d"))
    m = d.agg(F.min("d")).first()[0]
    if m is None:
        return df.sparkSession.createDataFrame([(0.0,)], "gap double")
    # second pass: every gap an integer multiple of the smallest one
    q = F.col("d") / F.lit(m)
    return d.agg(F.when(F.bool_and(F.abs(F.round(q) - q) < 1e-3), F.lit(float(m)))
                 .otherwise(F.lit(0.0)).alias("gap"))


@dataclass
class Cyclical:
    lo: float | None
    hi: float | None
    gap: float

    def columns(self, col: str | Column) -> tuple[Column, Column]:
        c = (F.col(col) if isinstance(col, str) else col).cast("double")
        if self.lo is None or self.lo == self.hi:
            return F.lit(0.0), F.lit(1.0)
        angle = (c - F.lit(self.lo)) / F.lit((self.hi - self.lo) + self.gap) * F.lit(2 * 3.141592653589793)
        return F.sin(angle), F.cos(angle)


def cyclical_fit(df: DataFrame, col: str) -> Cyclical:
    """Fit (min, max, gap) once; apply to any table (also to a stream)."""
    st = df.agg(F.min(F.col(col).cast("double")).alias("lo"),
                F.max(F.col(col).cast("double")).alias("hi")).first()
    if st["lo"] is None or st["lo"] == st["hi"]:
        return Cyclical(st["lo"], st["hi"], 0.0)
    gap = discrete_gap(df, col).first()["gap"]
    return Cyclical(st["lo"], st["hi"], float(gap or 0.0))
