"""Intermediate tables in the shared folder of the cluster.

Lineage is cut by writing Parquet below ``spark.checkpoint.dir``, which every
executor and the driver see, so a lost executor costs the tasks it was running
and nothing that was written. Only where the session names no folder (tests,
single-process sessions) one is made.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local one only if unset on a
    session whose executors live in the driver's process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = held.get() if held.isDefined() else None
    if not path:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


#: Spark's setting that removes the shuffle files of a query when it ends, instead of when the driver collects garbage
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_parent: ContextVar[str | None] = ContextVar("parent", default=None)


def write(df: DataFrame, path: str) -> None:
    """Write a table as Parquet. It is read from there ever after, so its shuffle files go at once."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN, None)
    conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            conf.unset(_CLEAN)
        else:
            conf.set(_CLEAN, before)


@contextmanager
def inside(ws: Workspace, name: str):
    """Workspaces made in the block keep their tables and results in a folder of ``ws``, which goes at the block's end:
    what is still needed must have been kept by ``ws``."""
    path = f"{ws.root}/{name}"
    token = _parent.set(path)
    try:
        yield
    finally:
        _parent.reset(token)
        ws.remove(path)


class Workspace:
    """Tables of one operator run. ``keep`` writes a table and reads it again;
    ``close`` writes the result and removes all tables kept before."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{_parent.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/t{self.n}"
        write(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, path: str) -> None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def drop(self) -> None:
        """Remove the kept tables; what reads them must have ended."""
        self.remove(self.root)

    def close(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}-out"
        write(df, path)
        self.drop()
        return self.spark.read.schema(df.schema).parquet(path)


def placed(rows: DataFrame, *cols: str) -> DataFrame:
    """``cols`` and ``row_key``, a whole number of each row's own: its place in the Parquet files it is read from, which neither
    a repeated task nor a later scan can change. So a table that is a plain read of such files needs no copy;
    any other is written once."""
    spark = rows.sparkSession
    place = [F.col("_metadata.file_path").alias("row_file"), F.col("_metadata.row_index").alias("row_at")]

    def located(df: DataFrame) -> DataFrame | None:
        if not df._jdf.queryExecution().analyzed().children().isEmpty():  # a join or a filter above the files: rows may repeat or change
            return None
        try:
            return df.select(*cols, *place)
        except AnalysisException:  # not from Parquet files
            return None

    at = located(rows)
    if at is None:
        at = located(Workspace(spark, "rows").keep(rows.select(*cols)))
    files = sorted(r[0] for r in at.select("row_file").distinct().collect())
    numbers = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "row_file string, row_no long")
    return at.join(F.broadcast(numbers), "row_file").select(*cols, (F.shiftleft("row_no", 33) + F.col("row_at")).alias("row_key"))
