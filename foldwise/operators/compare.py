"""Model comparison (E9-E12, V7, V8): leaderboards, tied ranks, Nemenyi
critical difference and groups, depth impact.  Inputs are small result
tables (configs x folds); all steps are DataFrame aggregates and windows
partitioned by model or fold.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Nemenyi q(alpha = 0.05) for 1..10 methods, as the reference
# tabulates them (the alpha argument is not used).
Q_ALPHA_05 = [0.0, 1.960, 2.343, 2.569, 2.728, 2.850, 2.949, 3.031, 3.102, 3.164]

# Depth-impact verdict thresholds (percent).
DEPTH_SIGNIFICANT = 5.0


def leaderboard(results: DataFrame, score: str = "acc_mean", model: str = "model",
                config: str = "config_id") -> DataFrame:
    """Every config ranked by score (desc, ties by config id); ``best`` = '*'
    on the first maximum of each model."""
    w_all = Window.partitionBy(model).orderBy(F.col(score).desc(), F.col(config))
    return (results.withColumn("model_rank", F.row_number().over(w_all).cast("bigint"))
            .withColumn("best", F.when(F.col("model_rank") == 1, F.lit("*")).otherwise(F.lit(""))))


def overall_order(results: DataFrame, score: str = "acc_mean", model: str = "model",
                  config: str = "config_id") -> DataFrame:
    """All configs of all models in one order, best first (``place`` from 1;
    ties by model and config).  A sweep's result table is small."""
    w = Window.orderBy(F.col(score).desc(), F.col(model), F.col(config))
    return results.withColumn("place", F.row_number().over(w).cast("bigint"))


def tied_ranks(perf: DataFrame, block: str = "fold", method: str = "method", value: str = "value",
               lower_is_better: bool = False) -> DataFrame:
    """Rank of each method within each block (1 = best), ties get the mean
    of their positions."""
    order = F.col(value).asc() if lower_is_better else F.col(value).desc()
    w = Window.partitionBy(block).orderBy(order)
    tie = Window.partitionBy(block, value)
    return perf.withColumn("rank", (F.rank().over(w) + (F.count(F.lit(1)).over(tie) - 1) / 2.0).cast("double"))


def nemenyi_cd(ranks: DataFrame, block: str = "fold", method: str = "method") -> DataFrame:
    """Mean rank per method plus CD = q(k) * sqrt(k (k + 1) / (6 N)),
    k = methods, N = blocks."""
    mean = ranks.groupBy(method).agg(F.avg("rank").alias("mean_rank"))
    kn = ranks.agg(F.count_distinct(method).alias("k"), F.count_distinct(block).alias("n_blocks"))
    q = F.element_at(F.array(*[F.lit(v) for v in Q_ALPHA_05]), F.col("k").cast("int"))
    cd = kn.select("k", "n_blocks", (q * F.sqrt(F.col("k") * (F.col("k") + 1) / (6.0 * F.col("n_blocks")))).alias("cd"))
    return _attach(mean, cd)


def _attach(left: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach a one-row table's columns to every row (join on a constant key)."""
    return (left.withColumn("_k", F.lit(1))
            .join(F.broadcast(one_row.withColumn("_k", F.lit(1))), "_k").drop("_k"))


def nemenyi_groups(cd_table: DataFrame, method: str = "method") -> DataFrame:
    """Methods sorted by mean rank, cut greedily into groups: a group is the
    run of methods within CD of its first member.  The table has at most
    ten rows (the q table's range), so the run is cut on the driver."""
    rows = cd_table.orderBy("mean_rank", method).limit(len(Q_ALPHA_05) + 1).collect()
    if len(rows) > len(Q_ALPHA_05):
        raise ValueError("Nemenyi groups support at most 10 methods")
    out, gid, start = [], 0, None
    for r in rows:
        if start is None or r["mean_rank"] - start > r["cd"] + 1e-12:
            gid += 1
            start = r["mean_rank"]
        out.append((r[method], float(r["mean_rank"]), gid))
    return cd_table.sparkSession.createDataFrame(out, f"{method} string, mean_rank double, grp int")


def depth_impact(sweep: DataFrame, depth: str = "max_depth", score: str = "acc_mean",
                 reference_depth: int = 4) -> DataFrame:
    """Relative accuracy change (percent) of the deepest tree against
    ``reference_depth``, with the verdict."""
    deepest = sweep.agg(F.max(depth).alias("_d"))
    top = sweep.join(deepest, sweep[depth] == deepest["_d"]).select(F.col(score).alias("acc_max"), F.col(depth).alias("depth_max"))
    ref = sweep.where(F.col(depth) == reference_depth).select(F.col(score).alias("acc_ref"))
    j = _attach(top, ref)
    pct = (F.col("acc_max") - F.col("acc_ref")) / F.col("acc_max") * 100
    return j.select("depth_max", "acc_max", "acc_ref", pct.alias("impact_pct"),
                    F.when(pct > DEPTH_SIGNIFICANT, F.lit("significant"))
                    .when(pct > 0, F.lit("slight")).otherwise(F.lit("none")).alias("verdict"))


def per_fold_comparison(pred: DataFrame, model: str = "model", fold: str = "fold") -> DataFrame:
    """V7: fold x method accuracy matrix from one prediction table."""
    return pred.groupBy(fold, model).agg(
        F.avg((F.col("actual") == F.col("predicted")).cast("double")).alias("value"))


def critical_difference_value(k: int, n_blocks: int) -> float:
    return Q_ALPHA_05[k - 1] * math.sqrt(k * (k + 1) / (6.0 * n_blocks))
