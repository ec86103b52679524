"""Mixing sources to target weights by pivotal dependent rounding.

Each source has a target number of words; a document of the source is wanted
``target / source size`` times, a whole number plus a fraction. The fractions
are rounded in pairs: words move at random between two documents, without
changing the expectation of either, until one fraction is 0 or 1, and the other
one goes on to the next document. A source's total of words is kept by every
such step, so all but the last open fraction are settled without an error.

The pairs form a reduction tree: documents are dealt by hash into blocks of
about ``BLOCK`` rows of one source, every block settles all its documents but
one, and the open ones meet in blocks of the next level. A source that holds a
third of all rows is many blocks; no level needs more than one block in a task.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.textkit import mix, word_count
from foldwise.llm.work import Workspace

BLOCK = 4096
#: most sources whose table (about 50 bytes each) is broadcast; above it they are joined
MAX_BROADCAST_SOURCES = 100_000
#: equal rows that are written out by one array
RUN = 1 << 16


def pivot(frame: pd.DataFrame, seed: int, final: bool) -> pd.DataFrame:
    """Settle a block: columns doc_id, rank, size, part (the fraction); ``up``
    becomes 0 or 1, or stays null for the one document left open. ``final``
    settles that one too, with its fraction as probability. A column row_key
    orders rows that are alike otherwise. Long texts come first, so that the open document is mostly a short one."""
    by = ["size", "rank", "doc_id", *(["row_key"] if "row_key" in frame else [])]
    frame = frame.sort_values(by, ascending=[False] + [True] * (len(by) - 1), kind="stable", ignore_index=True)
    size, part = frame["size"].to_numpy(np.float64), frame["part"].to_numpy(np.float64).copy()
    key = mix(frame["rank"].to_numpy(np.int64).view(np.uint64) ^ np.uint64(seed & (1 << 63) - 1))
    draw = (mix(key + np.arange(1, len(key) + 1, dtype=np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0**53
    up = np.full(len(size), -1, np.int64)
    i = -1
    for j in range(len(size)):
        if i < 0:
            i = j
            continue
        si, sj, pi, pj = size[i], size[j], part[i], part[j]
        gain, loss = min((1 - pi) * si, pj * sj), min(pi * si, (1 - pj) * sj)
        if draw[j] * (gain + loss) < loss:  # words move from j to i
            full, none = (1 - pi) * si <= pj * sj, pj * sj <= (1 - pi) * si
            part[i], part[j] = pi + gain / si, pj - gain / sj
            if full:
                up[i] = 1
            if none:
                up[j] = 0
        else:
            none, full = pi * si <= (1 - pj) * sj, (1 - pj) * sj <= pi * si
            part[i], part[j] = pi - loss / si, pj + loss / sj
            if none:
                up[i] = 0
            if full:
                up[j] = 1
        i = -1 if up[i] >= 0 and up[j] >= 0 else (j if up[i] >= 0 else i)
    if i >= 0 and final:
        up[i] = int(draw[i] < part[i])
    frame["part"] = part
    frame["up"] = pd.array(np.where(up < 0, 0, up), dtype="Int64")
    if i >= 0 and not final:
        frame.loc[i, "up"] = pd.NA
    return frame


def _settle(seed: int, final: bool):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return pivot(frame, seed, final)

    return run


def source_targets(rows: DataFrame, ws: Workspace, most: int = 3) -> DataFrame:
    """(sid, source, n, source_size, weight, target) of each source: weights
    1, 2, 3 repeating in code point order, null last; targets share all words
    by weight, none above ``most`` times its source's size."""
    spark = rows.sparkSession
    last = F.col("source").asc_nulls_last()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    table = table.repartitionByRange(parts, last).sortWithinPartitions(last)
    table = ws.keep(table.withColumn("pid", F.spark_partition_id()).withColumn("i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
    before, start = {}, 0
    for r in sorted(table.groupBy("pid").count().collect(), key=lambda r: r["pid"]):
        before[r["pid"]], start = start, start + r["count"]
    if not before:
        return table.select(F.col("i").alias("sid"), "source", "n", "source_size", F.lit(0).alias("weight"), F.lit(0.0).alias("target"))
    offset = F.create_map(*[F.lit(int(x)) for kv in before.items() for x in kv])[F.col("pid")]
    table = table.withColumn("sid", (F.col("i") + offset).cast("long")).withColumn("weight", (F.col("sid") % 3 + 1).cast("int"))
    table = table.withColumn("cap", F.col("source_size") * most)
    total = table.agg(F.sum("source_size")).first()[0] or 0
    share = None
    while True:  # each round caps more sources, so it ends; one small aggregate a round
        full = F.lit(False) if share is None else F.col("weight") * F.lit(share) > F.col("cap")
        taken, weight, n_full = table.agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight"))), F.sum(full.cast("int"))).first()
        new = (total - taken) / weight if weight else math.inf
        if share is not None and n_full == done:
            break
        share, done = new, n_full
        if not weight:
            break
    full = F.col("weight") * F.lit(share) > F.col("cap")
    target = F.when(full, F.col("cap").cast("double")).otherwise(F.least(F.col("weight") * F.lit(share), F.col("cap").cast("double")))
    return table.select("sid", "source", "n", "source_size", "weight", target.alias("target"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Equal rows with a running number ``again``: they are counted (combined before the shuffle)
    and written out again, so the numbers don't depend on how the table is partitioned."""
    cols = rows.columns
    counted = rows.groupBy(*cols).agg(F.count("*").alias("n"))
    counted = counted.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / RUN))))
    last = F.least(F.col("n") - 1, F.col("run") * RUN + RUN - 1)
    return counted.withColumn("again", F.explode(F.sequence(F.col("run") * RUN, last))).select(*cols, "again")


def mix_sources(docs: DataFrame, *, most: int = 3, seed: int = 20240607, block: int = BLOCK, row_key: str | None = None) -> DataFrame:
    """One row per input row: doc_id, size (words), source_size, target (of its
    source, in words), copies (0 to ``most``) and taken (words the mix takes).

    Uses doc_id, text and source alone. A null text has size 0; a null source is
    a source of its own, the last in order; a text without words is taken
    without words, in the whole part of its source's ratio. Repeated rows are
    documents of their own, told apart by a running number, so rows that share a doc_id, or have
    none, are dealt into as many blocks as others. The draws depend on the rows and ``seed`` alone, so
    reruns agree; an empty table gives an empty result.

    ``row_key`` names a stored column of unique whole numbers; the result has it
    as row_key, and it tells equal rows without a doc_id apart in the draws.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "mixing")
    keys = ["row_key"] if row_key else []
    rows = docs.select(*[F.col(row_key).cast("long").alias(k) for k in keys], F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.xxhash64(F.col("text").cast("string")).alias("content"), word_count(F.col("text")).alias("size"))
    rows = ws.keep(rows if keys else _numbered(rows))
    sources = ws.keep(source_targets(rows, ws, most))
    n_sources, most_rows = sources.agg(F.count("*"), F.max("n")).first()
    side = F.broadcast(sources) if n_sources <= MAX_BROADCAST_SOURCES else sources
    rows = rows.join(side.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("source", "s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = rows.withColumn("whole", F.floor(ratio).cast("long")).withColumn("part", ratio - F.floor(ratio))
    apart = [F.when(F.col("doc_id").isNull(), F.col(k)) for k in keys] or [F.col("again")]  # a null leaves the hash as it is
    rows = rows.withColumn("rank", F.xxhash64(F.lit(seed), "doc_id", "content", *apart))
    open_ = (F.col("part") > 0) & (F.col("size") > 0)
    cols = [*keys, "doc_id", "size", "source_size", "target", "whole", "part", "rank", "sid", "n"]
    settled = rows.where(~open_).select(*cols, F.lit(0).cast("long").alias("up"))
    blocks = F.ceil(F.col("n") / F.lit(block)).cast("long")
    live = rows.where(open_).select(*cols, F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id", "content", *apart), blocks).alias("blk"))
    count, level = -(-(most_rows or 0) // block), 0
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in live.schema if f.name != "up") + ", up long"
    while True:
        final, salt = count <= 1, seed + 31 * level
        done = ws.keep(live.groupBy("sid", "blk").applyInPandas(_settle(salt, final), schema))
        settled = settled.unionByName(done.where("up is not null").select(*cols, "up"))
        if final:
            break
        live = done.where("up is null").select(*cols, F.floor(F.col("blk") / F.lit(block)).alias("blk"))
        count, level = -(-count // block), level + 1
    copies = F.col("whole") + F.col("up")
    return ws.close(settled.select(*keys, "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies")))


def op7_pivotal_mixing(spark, sf_dir: str) -> DataFrame:
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"))
