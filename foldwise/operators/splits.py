"""Hold-out, k-fold (plain / stratified / grouped), batches and row
selection (E1-E8, C1-C3).

Randomness is a portable order key ``md5('<seed>:<row_id>')``: the same split
comes out of any engine with md5, and a re-run task draws the same numbers.
Sizes follow the reference: test size round(N*P) with ties to even.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.functions.common import hash_key
from foldwise.operators.sequence import dense_seq, null_safe_join, seq_by_hash


def _round_even(x):
    return F.bround(x, 0).cast("bigint")


def permutation(df: DataFrame, seed: int = 42, id_col: str = "row_id", *, group_cols=(),
                name: str = "perm", total: str | None = None) -> DataFrame:
    """Random position 0..N-1 of every row (optionally within groups)."""
    return seq_by_hash(df, hash_key(id_col, seed), id_col, group_cols=group_cols, name=name, total=total)


def hold_out(df: DataFrame, p_test: float, seed: int = 42, id_col: str = "row_id",
             out: str = "split") -> DataFrame:
    """Test = first round(N*P) rows of a random permutation; rest train."""
    assert 0.0 <= p_test <= 1.0
    d = permutation(df, seed, id_col, name="_perm", total="_n")
    n_test = _round_even(F.col("_n") * F.lit(float(p_test)))
    return (d.withColumn(out, F.when(F.col("_perm") < n_test, F.lit("test")).otherwise(F.lit("train")))
            .drop("_perm", "_n"))


def hold_out3(df: DataFrame, p_val: float, p_test: float, seed: int = 42, id_col: str = "row_id",
              out: str = "split") -> DataFrame:
    """Test round(N*Pt); validation from the rest with ratio Pv*N/N'."""
    assert 0 <= p_val <= 1 and 0 <= p_test <= 1 and p_val + p_test <= 1
    d = permutation(df, seed, id_col, name="_perm", total="_n")
    n = F.col("_n")
    n_test = n - _round_even(n * F.lit(1.0 - p_test))
    rest = n - n_test
    n_val = rest - _round_even(rest - F.lit(float(p_val)) * n)
    p = F.col("_perm")
    lab = (F.when(p < n_test, F.lit("test"))
           .when(p < n_test + n_val, F.lit("val")).otherwise(F.lit("train")))
    return d.withColumn(out, lab).drop("_perm", "_n")


def kfold(df: DataFrame, k: int, seed: int = 42, id_col: str = "row_id", out: str = "fold") -> DataFrame:
    """1..k repeated over a random permutation: fold sizes differ by <= 1."""
    d = permutation(df, seed, id_col, name="_perm")
    return d.withColumn(out, (F.pmod(F.col("_perm"), F.lit(k)) + 1).cast("int")).drop("_perm")


def stratified_kfold(df: DataFrame, k: int, label: str = "label", seed: int = 42,
                     id_col: str = "row_id", out: str = "fold") -> DataFrame:
    """kfold restarted inside each class."""
    d = permutation(df, seed, id_col, group_cols=[label], name="_perm")
    return d.withColumn(out, (F.pmod(F.col("_perm"), F.lit(k)) + 1).cast("int")).drop("_perm")


def grouped_kfold(df: DataFrame, k: int, group: str = "grp", seed: int = 42, out: str = "fold") -> DataFrame:
    """kfold over distinct groups; every row of a group gets its group's fold."""
    groups = df.select(group).distinct()
    gf = kfold(groups, k, seed, id_col=group, out=out)
    return null_safe_join(df, gf, [group])


def grouped_kfold_report(df: DataFrame, fold: str = "fold", group: str = "grp") -> DataFrame:
    return df.groupBy(fold).agg(F.count(F.lit(1)).alias("n_rows"),
                                F.count_distinct(group).alias("n_groups"))


def group_hold_out(df: DataFrame, p_test: float, group: str = "grp", seed: int = 42,
                   out: str = "split") -> DataFrame:
    """Permute distinct groups; a group's rows all go to one side."""
    groups = hold_out(df.select(group).distinct(), p_test, seed, id_col=group, out=out)
    return null_safe_join(df, groups, [group])


def members(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` is in ``ids`` (semi join; AQE broadcasts a small id list)."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def select_rows(df: DataFrame, picks: DataFrame, id_col: str = "row_id", ord_col: str = "ord") -> DataFrame:
    """Positional take: ``picks(ord, row_id)`` keeps order and duplicates."""
    return picks.select(ord_col, id_col).join(df, id_col)


def split_by_fold(df: DataFrame, f: int, fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(fold) != f), df.where(F.col(fold) == f)


def row_seq(df: DataFrame, order_key: str, tie: str | None = None, name: str = "seq",
            total: str | None = None) -> DataFrame:
    """0..N-1 in the order of a numeric key (ties by ``tie``); ``total``
    adds the row count as a column (computed in the same plan)."""
    order = [F.col(order_key)] + ([F.col(tie)] if tie else [])
    return dense_seq(df, order, numeric_key=order_key, name=name, total=total)


def batches(df: DataFrame, size: int, seq: str = "seq", shuffle: bool = False, seed: int = 42,
            id_col: str = "row_id", out: str = "batch") -> DataFrame:
    """Consecutive chunks of ``size`` rows by ``seq`` (last may be short);
    ``shuffle`` numbers the rows by the hash order first."""
    if shuffle:
        df = permutation(df, seed, id_col, name="_bseq")
        s = F.col("_bseq")
    else:
        s = F.col(seq)
    out_df = df.withColumn(out, F.floor(s / F.lit(size)).cast("bigint"))
    return out_df.drop("_bseq") if shuffle else out_df


def union_batches(*parts: DataFrame, ord_col: str = "part") -> DataFrame:
    """Vertical concatenation; ``part`` records which input a row came from."""
    out = None
    for i, p in enumerate(parts):
        p = p.withColumn(ord_col, F.lit(i))
        out = p if out is None else out.unionByName(p)
    return out
