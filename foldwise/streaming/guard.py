"""A source guard: repeated and late rows of a stream are counted, kept aside and never lost silently.

``guarded`` is the operator form: an event-time watermark and ``dropDuplicatesWithinWatermark``; rows later than the watermark
are only counted in the query's progress. ``run_guard`` keeps them: every micro-batch is split into accepted, repeated and late
rows against the state of the micro-batches before it (the largest event time, and the accepted ids that are not yet
older than the watermark), and all four tables are written under the micro-batch's number, so a replay writes the same.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldwise.streaming.live import _epoch_path, _latest_state


def guarded(stream: DataFrame, time: str, key: str | list[str], delay: str) -> DataFrame:
    """``stream`` without rows whose key was seen within the watermark ``delay``."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key] if isinstance(key, str) else list(key))


def dropped(query) -> tuple[int, int]:
    """(late, repeated): rows that the operators of a ``guarded`` query have dropped so far, from its progress. A row counts
    as late once it is behind the watermark of the micro-batch before; until then its key is still known and it is repeated."""
    ops = [op for p in query.recentProgress for op in p.stateOperators]
    return sum(int(op.numRowsDroppedByWatermark) for op in ops), sum(int(op.customMetrics.get("numDroppedDuplicateRows", 0)) for op in ops)


def guard_step(base: str, time: str, key: list[str], delay_s: float):
    """foreachBatch function. The watermark of a micro-batch is the largest event time of all before it less the delay; a row
    earlier than that, or without a time, is late; the first row of a key (by time) is accepted, later ones are repeated."""

    def step(rows: DataFrame, epoch: int) -> None:
        spark = rows.sparkSession
        state = _latest_state(spark, base, "state", epoch)  # accepted keys with their times
        top = None if state is None else state.agg(F.max(F.col(time).cast("double"))).first()[0]
        rows = rows.withColumn("_row", F.monotonically_increasing_id())
        mark = F.lit(None).cast("double") if top is None else F.lit(top - delay_s)
        at = F.col(time).cast("double")
        late = at.isNull() | F.coalesce(at < mark, F.lit(False))
        seen = (state.select(*key).distinct() if state is not None else rows.select(*key).limit(0)).withColumn("_seen", F.lit(True))
        on_time = rows.withColumn("_late", late).join(seen, key, "left")
        nth = F.row_number().over(Window.partitionBy("_late", *key).orderBy(time, "_row"))
        kind = F.when(F.col("_late"), "late").when(F.col("_seen").isNotNull() | (F.col("_nth") > 1), "repeated").otherwise("accepted")
        path = _epoch_path(base, "rows", epoch)
        on_time.withColumn("_nth", nth).withColumn("kind", kind).drop("_late", "_seen", "_nth", "_row").write.mode("overwrite").partitionBy("kind").parquet(path)
        done = spark.read.schema(rows.drop("_row").schema.add("kind", "string")).parquet(path)
        kept = done.where("kind = 'accepted'").select(*key, time)
        kept = kept if state is None else kept.unionByName(state)
        newest = kept.agg(F.max(at)).first()[0]
        if newest is not None:
            kept = kept.where(at >= F.lit(newest - delay_s))
        kept.write.mode("overwrite").parquet(_epoch_path(base, "state", epoch))
        done.groupBy().agg(*[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in ("accepted", "repeated", "late")]).withColumn("epoch", F.lit(epoch)).write.mode("overwrite").parquet(_epoch_path(base, "counts", epoch))

    return step


def run_guard(spark: SparkSession, source: DataFrame, base: str, time: str, key: str | list[str], delay_s: float, timeout_s: int = 600) -> tuple[DataFrame, DataFrame]:
    """(rows with ``kind``: accepted, repeated or late; counts of each micro-batch). Every row of ``source`` has one row."""
    key = [key] if isinstance(key, str) else list(key)
    q = (source.writeStream.foreachBatch(guard_step(base, time, key, delay_s)).option("checkpointLocation", os.path.join(base, "_checkpoint")).trigger(availableNow=True).start())
    if not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream did not end in {timeout_s} s")
    rows = spark.read.schema(source.schema.add("kind", "string")).option("basePath", os.path.join(base, "rows")).parquet(os.path.join(base, "rows", "epoch=*"))
    return rows, spark.read.parquet(os.path.join(base, "counts")).select("epoch", "n_accepted", "n_repeated", "n_late")
