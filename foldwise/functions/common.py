"""Column-expression helpers shared by every operator (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits every reported double is rounded to, in Spark and in the SQL twins.
DIGITS = 6


def rnd(c: Column | str, digits: int = DIGITS) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits) + F.lit(0.0)


def ratio(num: Column, den: Column, default: float | Column) -> Column:
    """num/den, or ``default`` when den is 0 (ANSI mode raises on x/0)."""
    d = default if isinstance(default, Column) else F.lit(float(default))
    return F.when(den == 0, d).otherwise(num.cast("double") / den.cast("double"))


def hash_key(id_col: Column | str, seed: int) -> Column:
    """Portable pseudo-random order key: md5('<seed>:<id>').  The same
    string gives the same order in any SQL engine that has md5."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(c.cast("string"), F.lit(""))))  # a NULL id is an empty one


def to_features(*cols: str | Column) -> Column:
    """Numeric columns -> ARRAY<DOUBLE> feature vector."""
    return F.array(*[(F.col(c) if isinstance(c, str) else c).cast("double") for c in cols])


def ts_micros(col: Column | str) -> Column:
    """Microseconds since 1970 of a TIMESTAMP_NTZ (wall-clock) column, free
    of the session time zone (a cast to TIMESTAMP would depend on it)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
