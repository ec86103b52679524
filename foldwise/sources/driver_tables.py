"""Feature-table views of the driver's parquet tables.

Every operator works on ``(row_id BIGINT, features ARRAY<DOUBLE>, label ...)``
plus optional ``grp``/``seq`` columns.  These builders are plain projections
(column pruning and pushdown reach the parquet scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.functions.common import to_features
from foldwise.session import table


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64 features, 10 classes (digits-shaped; labels carry no signal)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").cast("bigint").alias("row_id"),
        F.col("embedding").cast("array<double>").alias("features"),
        F.col("label").cast("string").alias("label"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped table: customer is the group ('subject'), priority the label."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        F.col("o_custkey").alias("grp"),
        to_features("o_totalprice").alias("features"),
        F.col("o_orderpriority").alias("label"),
    )


def part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Separable binary table: label p_size > 25."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("row_id"),
        to_features("p_size", "p_retailprice").alias("features"),
        (F.col("p_size") > 25).cast("string").alias("label"),
    )


LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lineitem(spark: SparkSession, sf_dir: str, label: str = "l_returnflag") -> DataFrame:
    """Wide numeric table without a row id (only aggregates use it)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*LINEITEM_FEATURES, F.col(label).alias("label"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered stream rows: ``hour`` and ``value`` raw, label purchase."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "ts", "value",
        F.hour("ts").alias("hour"),
        (F.col("event_type") == "purchase").alias("label"),
    )
