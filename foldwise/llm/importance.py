"""Quality classifier by importance resampling.

Two generative models over hashed n-grams (words and word pairs in ``BUCKETS``
buckets) are counted: one of the target text, one of all raw text. The logarithm
of the ratio of a document's probabilities under them is its importance
weight, taken for a passage of ``PASSAGE`` of its n-grams (that many times the mean over
all of them), so that long texts aren't preferred. Gumbel noise is added to it unscaled and the k
largest keys are taken: a draw without replacement in proportion to the weights.

Counts are summed inside tasks and then by Spark (one row per bucket). The k-th key
is found by radix selection: four aggregates, each over one more 16-bit digit of the
key, with at most 65536 groups, so neither a sort nor the keys pass the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.textkit import Words, buffers, pieces, windows
from foldwise.llm.work import Workspace

BUCKETS = 1 << 16
SMOOTH = 1.0
#: n-grams of the passage whose importance weight a text gets, the same for all texts
PASSAGE = 200
#: most labelled target rows (chosen by hash) that the target model is fitted on; their ids are broadcast
MAX_TARGET = 200_000


def _grams(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of all words and word pairs of a piece."""
    h = w.hashes(lower=True)
    two, at = windows(h, w.first, 2)
    shift = np.uint64(64 - 16)
    return np.concatenate([h >> shift, two >> shift]).astype(np.int64), np.concatenate([w.doc, w.doc[at]])


def _counts(docs: DataFrame) -> DataFrame:
    def run(batches):
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            data, off = buffers(batch.column(0))
            target = np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)
            for lo, hi in pieces(off):
                g, doc = _grams(Words(data, off, lo, hi))
                total[0] += np.bincount(g, minlength=BUCKETS)
                mine = target[lo:hi][doc]
                total[1] += np.bincount(g[mine], minlength=BUCKETS)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[0][at]), pa.array(total[1][at])], names=["b", "raw", "target"])

    return docs.select("text", "target").mapInArrow(run, "b int, raw long, target long").groupBy("b").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def importance_resample(docs: DataFrame, labels: DataFrame, *, share: float | None = None, seed: int = 11, max_target: int = MAX_TARGET) -> DataFrame:
    """One row per input row: doc_id, n_grams, log_weight (per n-gram), key and kept
    (among the k largest keys). k is ``share`` of the rows; without one, the share of
    target rows (quality 1 and not toxic) among the labelled ones. A row without
    n-grams (null or empty text) has weight null and isn't kept.

    The key is ``PASSAGE`` times log_weight plus Gumbel noise, so of two texts the one is drawn first with odds
    of exp(``PASSAGE`` times the difference). Rows with a null doc_id are weighed like others;
    draws depend on doc_id and ``seed`` alone; equal keys are decided by doc_id.
    Without target rows all weights are 0. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "importance")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    marks = labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long").alias("id"), F.coalesce(good, F.lit(False)).alias("good"))
    n_marks, n_good = marks.agg(F.count("*"), F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0))).first()
    if share is None:
        share = n_good / n_marks if n_marks else 1.0
    part = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, max_target / max(1, n_good)))
    picked = marks.where(F.col("good") & part).select("id").distinct()
    marked = docs.join(F.broadcast(picked), F.col("doc_id") == F.col("id"), "left").withColumn("target", F.col("id").isNotNull())
    table = _counts(marked).toPandas()
    count = np.zeros((2, BUCKETS))
    for k, name in enumerate(("raw", "target")):
        count[k, table["b"].to_numpy(np.int64)] = table[name].to_numpy(np.float64)
    p = (count + SMOOTH) / (count + SMOOTH).sum(1, keepdims=True)
    ratio = spark.sparkContext.broadcast(np.log(p[1] / p[0]) if count[1].any() else np.zeros(BUCKETS))

    def weigh(text: pa.Array) -> pa.Array:
        data, off = buffers(text)
        n, total = [np.zeros(0, np.int64)], [np.zeros(0)]
        for lo, hi in pieces(off):
            g, doc = _grams(Words(data, off, lo, hi))
            n.append(np.bincount(doc, minlength=hi - lo))
            total.append(np.bincount(doc, weights=ratio.value[g], minlength=hi - lo))
        n, total = np.concatenate(n), np.concatenate(total)
        w = np.divide(total, n, out=np.zeros(len(n)), where=n > 0)
        return pa.StructArray.from_arrays([pa.array(n.astype(np.int64)), pa.array(w, pa.float64(), mask=n == 0)], names=["n_grams", "log_weight"])

    rows = docs.select("doc_id", F.arrow_udf(weigh, "struct<n_grams: bigint, log_weight: double>")(F.col("text")).alias("r")).select("doc_id", "r.*")
    u = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    gumbel = -F.log(-F.log(u))
    rows = rows.withColumn("key", F.when(F.col("n_grams") > 0, F.lit(float(PASSAGE)) * F.col("log_weight") + gumbel))
    # keys lie far inside +-2**14 (a log ratio is below 50, the noise below 37); as a fixed-point number they keep 57 bits and their order
    fixed = F.floor((F.col("key") + (1 << 14)) * F.lit(float(1 << 42))).cast("long")
    rows = ws.keep(rows.withColumn("digits", F.when(F.col("key").isNotNull(), fixed)))
    n = rows.count()
    want = min(int(round(share * n)), rows.where("key is not null").count())
    bar, left = _kth_largest(rows.where("key is not null"), want)
    # rows on the bar itself: a handful (equal keys come from repeated rows), taken by doc_id
    tie = Window.partitionBy("digits").orderBy(F.col("doc_id").asc_nulls_last())
    on = rows.where(F.col("digits") == F.lit(bar)).withColumn("kept", F.row_number().over(tie) <= left)
    off = rows.where(F.coalesce(F.col("digits") != F.lit(bar), F.lit(True))).withColumn("kept", F.coalesce(F.col("digits") > F.lit(bar), F.lit(False)))
    cols = ["doc_id", "n_grams", "log_weight", "key", "kept"]
    return ws.close(off.select(*cols).unionAll(on.select(*cols)))


def _kth_largest(rows: DataFrame, k: int) -> tuple[int, int]:
    """(the k-th largest ``digits``, how many rows equal to it belong to the k)."""
    if k <= 0:
        return (1 << 62), 0
    prefix, left = 0, k
    for shift in (48, 32, 16, 0):
        part = rows if shift == 48 else rows.where(F.shiftright("digits", shift + 16) == F.lit(prefix))
        hist = part.groupBy(F.shiftright("digits", shift).alias("d")).count().collect()
        for r in sorted(hist, key=lambda r: -r["d"]):
            if r["count"] >= left:
                prefix = r["d"]
                break
            left -= r["count"]
    return prefix, left


def op4_importance_resampling(spark, sf_dir: str) -> DataFrame:
    return importance_resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
