"""Embedding near-duplicates by iterative quantisation and multi-index Hamming tables.

1. Equal vectors of a label are one *class* with a multiplicity, so copies cost one row.
2. On a bounded sample a rotation of the principal axes is learned that makes
   the signs of all axes balanced and the quantisation error small; every
   vector gets a binary code.
3. The code is cut into substrings, one hash table each: two codes that differ in
   fewer bits than there are tables agree in a whole substring. Every vector is in every table.
4. Inside a bucket (label, table, substring) the original vectors are compared in
   double precision, in salted pairs of row blocks where a bucket is large. A
   pair counts in the first table where its substrings agree, so each link is
   counted once; a block pair returns sums per vector and a spanning forest, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.components import components
from foldwise.llm.textkit import buffers
from foldwise.llm.work import Workspace

#: rows the rotation is fitted on (chosen by hash), rounds of the fit, bits of a code and of a substring
FIT_ROWS, FIT_ROUNDS, BITS, SUBSTRING = 20_000, 40, 64, 8
BLOCK = 512


def learn_rotation(sample: np.ndarray, bits: int, rounds: int, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): signs of (x - mean) @ projection are the bits."""
    mean = sample.mean(0)
    x = sample - mean
    _, axes = np.linalg.eigh(x.T @ x)
    axes = axes[:, ::-1][:, :bits]
    v = x @ axes
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1],) * 2))[0]
    for _ in range(rounds):
        b = np.where(v @ r >= 0, 1.0, -1.0)
        u, _, w = np.linalg.svd(b.T @ v)
        r = (u @ w).T
    return mean, axes @ r


def _matrix(col: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``width``."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    n = np.diff(col.offsets.to_numpy())
    out = np.zeros((len(n), width))
    out[np.arange(width)[None, :] < n[:, None]] = flat
    return out


def _codes(x: np.ndarray, mean: np.ndarray, proj: np.ndarray) -> np.ndarray:
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    bits = (unit - mean) @ proj >= 0
    return (bits.astype(np.uint64) << np.arange(bits.shape[1], dtype=np.uint64)[None, :]).sum(1, dtype=np.uint64)


def _runs(batches, keys: int):
    """Tables of the rows that agree in the first ``keys`` columns, which come sorted."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        new = np.zeros(batch.num_rows, bool)
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        first = tuple(c[0] for c in cols)
        new[0] = last is None or first != last
        edges = np.flatnonzero(new).tolist() + [batch.num_rows]
        if edges[0]:
            held.append(batch.slice(0, edges[0]))
        for a, b in zip(edges[:-1], edges[1:]):
            if held:
                yield pa.Table.from_batches(held)
            held = [batch.slice(a, b - a)]
        last = tuple(c[-1] for c in cols)
    if held:
        yield pa.Table.from_batches(held)


def near_vectors(vectors: DataFrame, *, threshold: float = 0.98, fit_rows: int = FIT_ROWS, substring: int = SUBSTRING) -> DataFrame:
    """One row per input row: vec_id, n_links (other vectors linked directly),
    component_id (smallest vec_id reachable by links) and kept (vec_id = component_id).

    Vectors link if their labels are equal and not null and their cosine is at
    least ``threshold``. Vectors that are null, empty, zero or hold null or
    non-finite components, and vectors of different lengths, don't link. Rows with
    the same or a null vec_id are vectors of their own; a null id is never a
    component's id while another one is in it. Columns other than vec_id, embedding and label aren't used.
    """
    spark = vectors.sparkSession
    ws = Workspace(spark, "itq")
    e = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("string").alias("label"))
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = F.coalesce(F.col("label").isNotNull() & finite & F.exists(e, lambda x: x != 0), F.lit(False))
    rows = ws.keep(rows.withColumn("cid", F.when(valid, F.xxhash64("label", "embedding"))))
    classes = ws.keep(rows.where("cid is not null").groupBy("cid", "label", "embedding").agg(F.min("vec_id").alias("low"), F.count("*").alias("m")))
    n, width = classes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    out = rows.select("vec_id", "cid")
    if not n:
        return ws.close(out.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")))
    picked = classes.where(F.pmod(F.xxhash64("cid"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, fit_rows / n)))
    sample = picked.select("cid", "embedding").limit(2 * fit_rows).toArrow().sort_by("cid")["embedding"].combine_chunks()
    if not len(sample):
        sample = classes.select("embedding").limit(1).toArrow()["embedding"].combine_chunks()
    x = _matrix(sample, width)
    mean, proj = learn_rotation(x / np.linalg.norm(x, axis=1, keepdims=True), min(BITS, width), FIT_ROUNDS)
    model = spark.sparkContext.broadcast((mean, proj))
    tables = -(-min(BITS, width) // substring)

    def index(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), width)
            code = _codes(x, *model.value).view(np.int64)
            raw = x.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(code), pa.array([raw[8 * width * i:8 * width * (i + 1)] for i in range(len(x))], pa.binary())],
                names=["cid", "key", "m", "code", "vector"])

    coded = ws.keep(classes.select("cid", "embedding", F.xxhash64("label", F.size("embedding")).alias("key"), "m").mapInArrow(
        index, "cid long, key long, m long, code long, vector binary"))
    entries = coded.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(tables - 1))))
    entries = entries.withColumn("sub", F.expr(f"cast(shiftrightunsigned(code, t * {substring}) & {(1 << substring) - 1} as int)"))
    sizes = entries.groupBy("key", "t", "sub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nb")).where("nb > 1")
    entries = entries.join(sizes, ["key", "t", "sub"], "left").withColumn("nb", F.coalesce("nb", F.lit(1)))
    entries = entries.withColumn("blk", F.pmod(F.xxhash64("cid"), F.col("nb")).cast("int"))
    entries = entries.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)))
    keys = ["key", "t", "sub", "i", "j"]
    entries = entries.select("key", "t", "sub", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "cid", "m", "code", "vector")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def links(batches):
        for run in _runs(batches, len(keys)):
            if run.num_rows < 2:
                continue
            t, i, j = (run[k][0].as_py() for k in ("t", "i", "j"))
            blk, cid, m, code = (run[k].to_numpy() for k in ("blk", "cid", "m", "code"))
            raw, _ = buffers(run["vector"])
            v = np.frombuffer(raw.tobytes(), np.float64).reshape(len(cid), width)
            norm = np.sqrt((v * v).sum(1))
            x, y = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
            near = (v[x] @ v[y].T) / (norm[x][:, None] * norm[y][None, :]) >= threshold
            if i == j:
                near = np.triu(near, 1)
            a, b = np.nonzero(near)
            a, b = x[a], y[b]
            differ = (code[a] ^ code[b]).view(np.uint64)
            first = np.ones(len(a), bool)
            for s in range(t):
                first &= (differ >> np.uint64(s * substring)) & np.uint64((1 << substring) - 1) != 0
            a, b = a[first], b[first]
            if not len(a):
                continue
            add = np.bincount(a, weights=m[b], minlength=len(cid)) + np.bincount(b, weights=m[a], minlength=len(cid))
            at = np.flatnonzero(add)
            root = np.arange(len(cid))
            tree = []
            for p, q in zip(a.tolist(), b.tolist()):
                while root[p] != p:
                    root[p] = root[root[p]]
                    p = root[p]
                while root[q] != q:
                    root[q] = root[root[q]]
                    q = root[q]
                if p != q:
                    root[max(p, q)] = min(p, q)
                    tree.append((p, q))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cid[np.concatenate([at, [p for p, _ in tree]]).astype(np.int64)]),
                 pa.array(np.concatenate([add[at].astype(np.int64), np.zeros(len(tree), np.int64)])),
                 pa.array([None] * len(at) + cid[[q for _, q in tree]].tolist(), pa.int64())], names=["cid", "n", "other"])

    found = ws.keep(entries.repartition(parts, *keys).sortWithinPartitions(*keys).mapInArrow(links, "cid long, n long, other long"))
    linked = found.where("other is null").groupBy("cid").agg(F.sum("n").alias("n"))
    tree = components(found.where("other is not null").select(F.col("cid").alias("a"), F.col("other").alias("b")), ws)
    classes = classes.select("cid", "low", "m").join(linked, "cid", "left").join(tree.withColumnRenamed("node", "cid"), "cid", "left")
    classes = classes.withColumn("component", F.coalesce("component", "cid")).withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("m") - 1)
    least = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = classes.join(least, "component").select("cid", "n_links", "component_id")
    out = out.join(classes, "cid", "left")
    component = F.when(F.col("cid").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return ws.close(out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")))


def op5_itq_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
