"""``dense_seq``: consecutive 0..N-1 numbers in a total order, without a
one-partition window and without any machine-local checkpoint.

Plan:
  1. every row gets a *bucket* that is a deterministic function of its own
     values (literal bounds), so buckets are ordered like the keys and a
     re-run task puts each row in the same bucket;
  2. counts per bucket (a map-side combined aggregate, ``n_buckets`` rows)
     -> exclusive running sum = the bucket's first number;
  3. ``row_number`` inside each bucket (window partitioned by the bucket).

The offsets table has at most ``groups x n_buckets`` rows.  With no group
columns it is broadcast (its size is the bucket count we chose); with group
columns (e.g. class labels) it joins normally so AQE decides by its real size.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HEX8 = float(16 ** 8)


def default_buckets(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


def hash_bucket(md5_col: Column, n_buckets: int) -> Column:
    """Bucket of an md5 hex key: its first 32 bits are uniform, so equal
    ranges of them hold equal shares of rows; no sampling needed."""
    top = F.conv(F.substring(md5_col, 1, 8), 16, 10).cast("double")
    return F.floor(top * F.lit(n_buckets) / F.lit(_HEX8)).cast("int")


def numeric_bucket(df: DataFrame, key: str, n_buckets: int, out: str,
                   rel_error: float = 1e-3) -> DataFrame:
    """Bucket a numeric key by its approximate quantiles.  The bounds are
    computed once and become literals of the plan (one pass over one column);
    they are not re-sampled when a task is re-run."""
    tmp = "_fw_key_d"
    keyed = df.withColumn(tmp, F.col(key).cast("double"))
    if n_buckets <= 1:
        return keyed.withColumn(out, F.lit(0)).drop(tmp)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = keyed.approxQuantile(tmp, probs, rel_error)
    splits = sorted(set(b for b in bounds if b is not None))
    splits = [float("-inf")] + splits + [float("inf")]
    bz = Bucketizer(splits=splits, inputCol=tmp, outputCol=out + "_d", handleInvalid="keep")
    return (bz.transform(keyed).withColumn(out, F.col(out + "_d").cast("int"))
            .drop(out + "_d", tmp))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal keys where NULL equals NULL; the keys come from the left."""
    r = right.select(*[F.col(k).alias(f"_ns_{i}") for i, k in enumerate(keys)],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for i, k in enumerate(keys):
        c = left[k].eqNullSafe(r[f"_ns_{i}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond).drop(*[f"_ns_{i}" for i in range(len(keys))])


def dense_seq(df: DataFrame, order_cols: list[str | Column], *, bucket: Column | None = None,
              numeric_key: str | None = None, group_cols: list[str] | tuple = (),
              name: str = "seq", total: str | None = None,
              n_buckets: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of the row in ``order_cols`` order,
    restarting per ``group_cols``.  ``order_cols`` must be a total order.

    Give either ``bucket`` (an int column monotone in the order, e.g.
    :func:`hash_bucket`) or ``numeric_key`` (first order column, numeric).
    ``total`` optionally adds the group's row count.
    """
    nb = n_buckets or default_buckets(df)
    group_cols = list(group_cols)
    b = "_fw_bucket"
    if bucket is not None:
        d = df.withColumn(b, bucket)
    elif numeric_key is not None:
        d = numeric_bucket(df, numeric_key, nb, b)
    else:
        d = df.withColumn(b, F.lit(0))
    counts = d.groupBy(*group_cols, b).agg(F.count(F.lit(1)).alias("_fw_n"))
    w = Window.partitionBy(*group_cols).orderBy(b)
    offs = counts.withColumn(
        "_fw_off",
        F.coalesce(F.sum("_fw_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    if total:
        offs = offs.withColumn(total, F.sum("_fw_n").over(Window.partitionBy(*group_cols)))
    offs = offs.drop("_fw_n")
    if not group_cols:
        offs = F.broadcast(offs)  # <= n_buckets + 1 rows, chosen above
    joined = null_safe_join(d, offs, [*group_cols, b])  # a NULL group is a group of its own
    rn = F.row_number().over(Window.partitionBy(*group_cols, b).orderBy(*order_cols))
    return (joined.withColumn(name, (F.col("_fw_off") + rn - 1).cast("bigint"))
            .drop(b, "_fw_off"))


def seq_by_hash(df: DataFrame, key: Column, tie: str, *, group_cols=(), name="seq",
                total: str | None = None, n_buckets: int | None = None) -> DataFrame:
    """Positions in the order of an md5 hex key (ties by ``tie``)."""
    k = "_fw_hkey"
    d = df.withColumn(k, key)
    nb = n_buckets or default_buckets(df)
    out = dense_seq(d, [F.col(k), F.col(tie)], bucket=hash_bucket(F.col(k), nb),
                    group_cols=group_cols, name=name, total=total, n_buckets=nb)
    return out.drop(k)
