"""Running counts / ranks per group without an unbounded window partition.

``running_sum(df, group, order, value)`` = for every row, the sum of
``value`` over rows of the same group that come strictly before it in
``order``.  The first group column (e.g. the feature name) gets its own
approximate quantile bounds (one aggregate, collected: groups x buckets
numbers); rows are bucketed by those literal bounds, bucket totals give
offsets (small table), and the window runs per (group, bucket) only.  Rows
that tie on one frequent value are cut further by their tie column.
"""

from __future__ import annotations

import bisect
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldwise.operators.sequence import default_buckets


#: most keys whose bounds are nested in one expression; more are looked up in a map of the same bounds
MAX_BRANCHES = 100


def _search_tree(bounds: list[float], x: Column, lo: int, hi: int) -> Column:
    """Number of bounds <= x among sorted ``bounds[lo:hi]`` (plus lo): a
    binary search unrolled into nested CASE WHEN (log2 comparisons/row)."""
    if lo >= hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(x >= F.lit(bounds[mid]), _search_tree(bounds, x, mid + 1, hi)).otherwise(
        _search_tree(bounds, x, lo, mid))


def _quantiles(df: DataFrame, keys: list[str], num: str, n_buckets: int) -> dict[tuple, list[float]]:
    """``n_buckets`` - 1 approximate quantiles of ``num`` per key, repeated where one value spans several."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    rows = df.groupBy(*keys).agg(F.percentile_approx(F.col(num).cast("double"), probs, 1000).alias("_q")).collect()
    return {tuple(r[k] for k in keys): [float(v) for v in r["_q"] or []] for r in rows}


def _bucket_of(per_key: dict[tuple, list[float]], keys: list[str], num: str) -> Column:
    """Number of the key's bounds that are <= ``num`` (0 for a key without bounds)."""
    x = F.col(num).cast("double")
    per_key = {k: v for k, v in per_key.items() if v}
    if not per_key:
        return F.lit(0)
    if len(per_key) <= MAX_BRANCHES and sum(len(v) for v in per_key.values()) <= 4096:
        # codegen-friendly: per key an unrolled binary search over literals
        expr = F.lit(0)
        for k, bounds in per_key.items():
            same = F.lit(True)
            for name, v in zip(keys, k):
                same = same & F.col(name).eqNullSafe(F.lit(v))
            expr = F.when(same, _search_tree(bounds, x, 0, len(bounds))).otherwise(expr)
        return expr.cast("int")
    m = F.create_map(*[v for k, b in per_key.items() for v in (F.lit(k[0]), F.array(*[F.lit(t) for t in b]))])
    return F.coalesce(F.size(F.filter(F.element_at(m, F.col(keys[0])), lambda b: b <= x)), F.lit(0)).cast("int")


def _with_tie_bucket(df: DataFrame, ties: dict[tuple, list[float]], keys: list[str], num: str, out: str) -> DataFrame:
    """Number of the key's bounds that are <= ``num``, the bounds in a broadcast table (groups x buckets numbers)."""
    fields = [T.StructField(f"_k{i}", df.schema[k].dataType) for i, k in enumerate(keys)]
    bounds = df.sparkSession.createDataFrame([(*k, v) for k, v in ties.items()], T.StructType([*fields, T.StructField("_bounds", T.ArrayType(T.DoubleType()))]))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    n = F.size(F.filter("_bounds", lambda b: b <= F.col(num).cast("double")))
    return df.join(F.broadcast(bounds), same, "left").withColumn(out, F.coalesce(n, F.lit(0)).cast("int")).drop("_bounds", *[f.name for f in fields])


def _bucket_expr(df: DataFrame, key: str, num: str, n_buckets: int) -> Column:
    if n_buckets <= 1:
        return F.lit(0)
    return _bucket_of({k: sorted(set(v)) for k, v in _quantiles(df, [key], num, n_buckets).items()}, [key], num)


_EXACT_AS_DOUBLE = (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType)


def bucketed(df: DataFrame, key: str, num: str, tie_cols: list[str], n_buckets: int) -> DataFrame:
    """``df`` with ``_rs_b`` (bucket by value) and ``_rs_tb`` (bucket by the first tie column, 0 unless needed);
    the pair is ordered like (value, ties). A value that spans several quantiles gets a bucket of its own, cut by the
    quantiles of its ties, so a value held by a third of the rows is many tasks."""
    if n_buckets <= 1:
        return df.withColumn("_rs_b", F.lit(0)).withColumn("_rs_tb", F.lit(0))
    raw = _quantiles(df, [key], num, n_buckets)
    split = bool(tie_cols) and isinstance(df.schema[num].dataType, _EXACT_AS_DOUBLE) and isinstance(df.schema[tie_cols[0]].dataType, T.NumericType)
    heavy = {k: sorted({v for v, w in zip(q, q[1:]) if v == w}) if split else [] for k, q in raw.items()}
    bounds = {k: sorted(set(q) | {math.nextafter(v, math.inf) for v in heavy[k]}) for k, q in raw.items()}
    d = df.withColumn("_rs_b", _bucket_of(bounds, [key], num))
    full = [(k[0], bisect.bisect_right(bounds[k], v)) for k, vs in heavy.items() for v in vs]
    if not full:
        return d.withColumn("_rs_tb", F.lit(0))
    wanted = F.broadcast(df.sparkSession.createDataFrame(full, T.StructType([T.StructField("_k", df.schema[key].dataType), T.StructField("_b", T.IntegerType())])))
    held = d.join(wanted, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_rs_b") == F.col("_b")), "left_semi")
    ties = {k: sorted(set(q)) for k, q in _quantiles(held, [key, "_rs_b"], tie_cols[0], n_buckets).items()}
    return _with_tie_bucket(d, ties, [key, "_rs_b"], tie_cols[0], "_rs_tb")


def running_sum(df: DataFrame, group_cols: list[str], order_num: str, value: str | list[str],
                out: str | list[str], tie_cols: list[str] = (), n_buckets: int | None = None,
                inclusive: bool = False) -> DataFrame:
    """Exclusive (or inclusive) running sums of one or more ``value``
    columns within ``group_cols`` ordered by ``order_num`` (numeric) then
    ``tie_cols``; all sums share one bucketed window pass."""
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out)
    nb = n_buckets or default_buckets(df)
    b = ["_rs_b", "_rs_tb"]
    d = bucketed(df, group_cols[0], order_num, list(tie_cols), nb)
    tot = d.groupBy(*group_cols, *b).agg(*[F.sum(v).alias(f"_rs_t{i}") for i, v in enumerate(values)])
    wo = Window.partitionBy(*group_cols).orderBy(*b).rowsBetween(Window.unboundedPreceding, -1)
    offs = tot.select(*group_cols, *b, *[F.coalesce(F.sum(f"_rs_t{i}").over(wo), F.lit(0)).alias(f"_rs_o{i}")
                                        for i in range(len(values))])
    j = d.join(offs, [*group_cols, *b])
    order = [F.col(order_num), *[F.col(c) for c in tie_cols]]
    frame = Window.partitionBy(*group_cols, *b).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    for i, (v, o) in enumerate(zip(values, outs)):
        j = j.withColumn(o, F.col(f"_rs_o{i}") + F.coalesce(F.sum(v).over(frame), F.lit(0)))
    return j.drop(*b, *[f"_rs_o{i}" for i in range(len(values))])


def ordinal_rank(long_df: DataFrame, group: str, value: str, tie: str, out: str = "rank") -> DataFrame:
    """1-based rank by value within ``group``, ties by ``tie`` (position)."""
    d = long_df.withColumn("_one", F.lit(1))
    return running_sum(d, [group], value, "_one", out, tie_cols=[tie], inclusive=True).drop("_one")


def average_ranks(counts: DataFrame, group: str, value: str, out: str = "rank") -> DataFrame:
    """1-based rank of each distinct value within ``group``, equal values sharing the mean of their positions.
    ``counts`` holds (group, value, n), one row per value, so a tie is ranked once however many rows it has."""
    below = running_sum(counts, [group], value, "n", "_below")
    return below.select(group, value, (F.col("_below") + (F.col("n") + 1) / 2).alias(out))
