"""Exact k nearest neighbours with metric pruning, for data of more than one block.

* Pivots come from a bounded sample; every data row goes to the cell of its nearest pivot, and a cell is
  cut into rings by the distance to the pivot (a ring that is still too large, e.g. of equal rows, by hash of the id). Each
  piece is a block: one packed row of at most about ``block_rows`` rows, with its centre and, as its radius table, the smallest and
  largest distance of its rows to the centre.
* Queries get cells and rings in the same way. A block of queries first meets one data block of its own ring: the k-th distance there
  bounds the k-th distance overall.
* By the triangle inequality a row of a data block is at least ``d(q, centre) - outer`` and ``inner - d(q, centre)`` away from q.
  Neighbouring blocks travel together as a shelf of up to ``SHELF`` bytes. A query is sent once to a shelf that the bound leaves, whatever the
  number of its blocks, and there meets only the blocks that its bound leaves; the bound falls with every block it has met.
* Inside a block, products of matrices give approximate distances; those that can be among the k best are computed again feature by feature,
  as an SQL sum would, and rounded. One window keeps the k best of the blocks visited.

With a scaler for each fold the radius table has one entry a fold: distances and bounds are those of the scaled space.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foldwise.session import cut_lineage

DIST_DIGITS = 9
#: sampled rows that pivots are fitted on, and most pivots (both reach the driver)
SAMPLE, PIVOTS = 4096, 512
#: query rows of a block and of one product, and bins of a cell's distances
QUERIES, TOGETHER, BINS = 512, 1024, 1024
#: most rows and feature bytes of the data blocks of a shelf, and of the queries that meet it in one task
SHELF_ROWS, SHELF = 1 << 16, 1 << 25
#: rows whose distances to all pivots are computed together
NEAREST = 256
#: query blocks that share a shipped data block
SHIP = 64


def sound(features: str, dim: int) -> Column:
    """Has a row all ``dim`` features, none missing or infinite?"""
    f = F.col(features)
    return f.isNotNull() & (F.size(f) == dim) & F.forall(f, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _matrix(col, dim: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), dim)


def _packed_list(*cols: pa.ChunkedArray, names=None) -> pa.Array:
    """One list value that holds a column, or the structs of several."""
    flat = [c.combine_chunks() for c in cols]
    values = pa.StructArray.from_arrays(flat, names=names) if names else flat[0]
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def scaled(x: np.ndarray, view) -> np.ndarray:
    """(x - lo) / (hi - lo), 0 for a constant feature; unchanged without a view."""
    if view is None:
        return x
    lo, hi = view
    span = hi - lo
    out = np.zeros_like(x)
    ok = span != 0
    out[:, ok] = (x[:, ok] - lo[ok]) / span[ok]
    return out


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of a to those of b, exact enough for bounds."""
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(sq, 0.0))


def _nearest(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of every row and the distance to it, few rows at a time: their matrices stay in a core's cache."""
    cell, dist = np.zeros(len(x), np.int32), np.zeros(len(x))
    for lo in range(0, len(x), NEAREST):
        d = _far(x[lo:lo + NEAREST], centers)
        cell[lo:lo + NEAREST], dist[lo:lo + NEAREST] = d.argmin(1), d.min(1)
    return cell, dist


def best_in_block(q: np.ndarray, x: np.ndarray, k: int, skip, bar: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, rounded squared distance) of the k nearest rows of every query that aren't above ``bar``,
    ties to the row that comes first. ``skip(i, j)``: pairs that don't count."""
    qq, xx = (q * q).sum(1), (x * x).sum(1)
    near = (-2.0 * q) @ x.T
    near += qq[:, None]
    near += xx[None, :]
    slack = 1e-9 * (qq + (xx.max() if len(xx) else 0.0)) + 2 * 10.0 ** -DIST_DIGITS
    loose = np.flatnonzero(np.isinf(bar))
    if len(loose) and near.shape[1] > k:
        some = near[loose]
        if skip is not None:
            some[skip(loose[:, None], np.arange(len(x))[None, :])] = np.inf
        bar = bar.copy()
        bar[loose] = np.partition(some, k - 1, axis=1)[:, k - 1] + slack[loose]
    i, j = np.nonzero(near <= (bar + slack)[:, None])
    ok = np.isfinite(near[i, j])
    if skip is not None:
        ok &= ~skip(i, j)
    i, j = i[ok], j[ok]
    d2 = np.zeros(len(i))
    for f in range(q.shape[1]):  # in the order of the features
        diff = q[i, f] - x[j, f]
        d2 += diff * diff
    d2 = np.round(d2, DIST_DIGITS)
    order = np.lexsort((j, d2, i))
    i, j, d2 = i[order], j[order], d2[order]
    keep = _nth(i) < k
    return i[keep], j[keep], d2[keep]


def _nth(i: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... inside each run of equal values of sorted ``i``."""
    return np.arange(len(i)) - np.searchsorted(i, i)


def _search(q: dict, d: dict, at: np.ndarray, bar: np.ndarray, k: int, views: dict, has_x: bool, done=None):
    """``best_in_block`` of the queries ``at`` against a block, view by view if every fold has its own scaler. ``done``: the number of the one
    view of all queries, and the scaled features of queries and block."""
    parts = []
    for v, view in enumerate(views.values()):
        if done is not None and done[0] != v:
            continue
        own = at if None in views or done is not None else at[q["view"][at] == v]
        if not len(own):
            continue

        def skip(i, j, own=own):
            out = False
            if has_x:
                out = q["x"][own[i]] == d["x"][j]
            if q["hash"] is not None:  # no table has both in one bucket
                apart = True
                for t in range(q["hash"].shape[1]):
                    apart = apart & (q["hash"][own[i], t] != d["hash"][j, t])
                out = out | apart
            return out

        f, x = (scaled(q["f"][own], view), scaled(d["f"], view)) if done is None else (done[1][own], done[2])
        i, j, d2 = best_in_block(f, x, k, skip if has_x or q["hash"] is not None else None, bar[own])
        parts.append((own[i], j, d2))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def _hashes(t: pa.Table) -> bytes:
    return t["hash"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).tobytes()


def _decoded(right: pa.Table, left: pa.Table | None, dim: int, views: dict) -> tuple[list[dict], list[dict]]:
    """Arrays of the query blocks and of the data blocks; ``x`` numbers the values of both sides, ``view`` those with a scaler."""
    lists = [t["xs"].combine_chunks()[i].values for t in (right, left) if t is not None for i in range(t.num_rows)]
    coded = pa.chunked_array(lists, type=right["xs"].type.value_type).combine_chunks().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    codes = coded.indices.to_numpy(zero_copy_only=False)  # a missing value is NaN and equals none
    known = {v: i for i, v in enumerate(views)}
    view = np.array([known.get(v, -1) for v in coded.dictionary.to_pylist()] + [-1])[np.where(np.isnan(codes), -1, codes).astype(int)]
    edge = np.concatenate([[0], np.cumsum([len(a) for a in lists])]).astype(int)
    out, n = [], 0
    for t in (right, left):
        for i in range(0 if t is None else t.num_rows):
            span = slice(edge[n], edge[n + 1])
            hash_ = t["hash"][i].as_py()
            out.append({"f": np.frombuffer(t["feats"][i].as_py()).reshape(-1, dim), "x": codes[span], "view": view[span], "hash": None if hash_ is None else np.frombuffer(hash_, np.int64).reshape(edge[n + 1] - edge[n], -1)})
            n += 1
    return out[:right.num_rows], out[right.num_rows:]


def _bounds(t: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Centres and radius tables (block, view, inner and outer)."""
    return np.stack([np.frombuffer(c) for c in t["center"].to_pylist()]).reshape(-1, dim), np.stack([np.frombuffer(c).reshape(-1, 2) for c in t["table"].to_pylist()])


def _least(q: dict, centers: np.ndarray, tables: np.ndarray, views: dict) -> tuple[np.ndarray, np.ndarray]:
    """Least distances that the radius tables leave between queries and blocks, and what rounding may take off them."""
    least, slack = np.zeros((len(q["f"]), len(centers))), np.zeros((len(q["f"]), len(centers)))
    for v, view in enumerate(views.values()):
        at = np.arange(len(q["f"])) if None in views else np.flatnonzero(q["view"] == v)
        if not len(at):
            continue
        qv, cv = scaled(q["f"][at], view), scaled(centers, view)
        d = _far(qv, cv)
        least[at] = np.maximum(d - tables[:, v, 1], tables[:, v, 0] - d)
        # more than the rounding of distances from matrix products
        slack[at] = 2e-7 * max(16, q["f"].shape[1]) ** 0.5 * (1 + np.sqrt((qv * qv).sum(1))[:, None] + np.sqrt((cv * cv).sum(1).max(initial=0.0)))
    return least, slack


class PrunedJoin:
    """The plan of one join; ``neighbours()`` is its result, ``report()`` what was visited."""

    def __init__(self, queries: DataFrame, data: DataFrame, k: int, *, dim: int, n_data: int, qid="row_id", did="row_id", features="features", carry=("label",),
                 exclude_same=None, within=None, block_rows=2048, scale_by=None, hashes=None):
        """``hashes``: a column of LSH buckets (an array of long, one a table) on both sides; rows that share none don't meet."""
        self.spark = data.sparkSession
        self.k, self.dim, self.block_rows, self.within = k, dim, block_rows, within
        self.types = {"query_id": queries.schema[qid].dataType, "data_id": data.schema[did].dataType, "w": data.schema[within].dataType if within else T.IntegerType(),
                      "x": data.schema[exclude_same].dataType if exclude_same else T.IntegerType()}
        self.carry = [data.schema[c] for c in carry]
        self.has_x, self.hashes = exclude_same is not None, hashes
        self.views = {v: (np.asarray(lo, np.float64), np.asarray(hi, np.float64)) for v, (lo, hi) in scale_by.items()} if scale_by else {None: None}
        key = [F.col(exclude_same).alias("x") if exclude_same else F.lit(0).alias("x"), F.col(within).alias("w") if within else F.lit(0).alias("w"), *([F.col(hashes).alias("hash")] if hashes else [])]
        self.shelf_rows = max(block_rows, min(SHELF_ROWS, SHELF // (8 * max(1, dim))))
        side = lambda df, id_, name, more: df.where(sound(features, dim)).select(F.col(id_).alias(name), F.col(features).alias("f"), *[F.col(c).alias(f"c_{c}") for c in more], *key)
        base = cut_lineage(self._celled(side(data, did, "data_id", carry), *self._pivots(data.where(sound(features, dim)), did, features, n_data)))
        asked = base.select(F.col("data_id").alias("query_id"), "f", "x", "w", *(["hash"] if hashes else []), "cell", "bin") if data is queries and qid == did else None
        if asked is None:
            asked = cut_lineage(self._celled(side(queries, qid, "query_id", ()), *self.pivots))
        rings = self._rings(base)
        self.blocks = cut_lineage(self._packed(base.join(rings, ["w", "cell", "bin"]).withColumn("part", F.pmod(F.xxhash64("data_id"), F.col("parts")).cast("int"))))
        self.n_blocks = self.blocks.count()
        asked = asked.join(rings, ["w", "cell", "bin"], "left").withColumn("ring", F.coalesce("ring", F.lit(0)))
        chunks = asked.groupBy("w", "cell", "ring").agg(F.ceil(F.count("*") / QUERIES).alias("chunks"))
        asked = asked.join(chunks, ["w", "cell", "ring"]).withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int"))
        self.asked = cut_lineage(self._bounded(self._packed_queries(asked)))

    # ---- cells, rings and blocks
    def _pivots(self, data: DataFrame, did: str, features: str, n: int):
        part = F.pmod(F.xxhash64(did), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / max(1, n)))
        x = _matrix(data.where(part).select(features).limit(2 * SAMPLE).toArrow()[features].combine_chunks(), self.dim) if n else np.zeros((0, self.dim))
        x = np.unique(x, axis=0)
        spread = x.std(0) if len(x) else np.ones(self.dim)
        unit = np.where(spread > 0, 1 / np.where(spread > 0, spread, 1), 0.0) if len(self.views) > 1 else np.ones(self.dim)
        x = x * unit
        most = max(1, min(PIVOTS, -(-2 * n // self.block_rows), len(x)))
        centers = x[np.linspace(0, len(x) - 1, most).astype(int)] if len(x) else np.zeros((1, self.dim))
        for _ in range(5):
            own = _far(x, centers).argmin(1) if len(x) else np.zeros(0, int)
            full = np.flatnonzero(np.bincount(own, minlength=len(centers)))
            centers = np.stack([x[own == c].mean(0) for c in full]) if len(full) else centers
        dist = _far(x, centers)
        reach = np.zeros(len(centers))
        if len(x):
            np.maximum.at(reach, dist.argmin(1), dist.min(1))
        self.pivots = (self.spark.sparkContext.broadcast((unit, centers, np.where(reach > 0, reach, 1.0))),)
        return self.pivots

    def _celled(self, df: DataFrame, pivots) -> DataFrame:
        cols, dim = df.columns, self.dim

        def run(batches):
            unit, centers, reach = pivots.value
            for b in batches:
                cell, dist = _nearest(_matrix(b.column(cols.index("f")), dim) * unit, centers)
                bin_ = np.minimum(BINS - 1, dist / reach[cell] * (BINS // 2)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(bin_)], names=[*cols, "cell", "bin"])

        return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("bin", T.IntegerType())]))

    def _rings(self, base: DataFrame) -> DataFrame:
        """(w, cell, bin) -> ring and parts; at most ``BINS`` rows a cell."""
        size = base.groupBy("w", "cell", "bin").agg(F.count("*").alias("n"))
        before = Window.partitionBy("w", "cell").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        # at most ``PIVOTS`` rows a value of w
        cells = size.groupBy("w", "cell").agg(F.sum("n").alias("n")).withColumn("ahead", F.sum("n").over(Window.partitionBy("w").orderBy("cell")) - F.col("n")).drop("n")
        place = F.coalesce(F.sum("n").over(before), F.lit(0))
        rings = size.select("w", "cell", "bin", place.alias("place"), F.floor(place / self.block_rows).cast("int").alias("ring"), F.ceil(F.col("n") / self.block_rows).alias("parts"))
        first = F.col("ahead") + F.col("ring") * self.block_rows  # of the ring's rows, the same for all its bins
        return rings.join(cells, ["w", "cell"]).select("w", "cell", "bin", "ring", "parts", F.floor(first / self.shelf_rows).cast("long").alias("shelf"))

    def _tasks(self, groups: int) -> int:
        """Tasks for groups that are few bytes and much work, which adaptive execution would put together."""
        return max(1, min(groups, max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 4 * self.spark.sparkContext.defaultParallelism)))

    def _packed(self, rows: DataFrame) -> DataFrame:
        names, dim, views = ["data_id", *[f"c_{f.name}" for f in self.carry]], self.dim, self.views
        out = T.StructType([T.StructField("w", self.types["w"]), *[T.StructField(c, T.IntegerType()) for c in ("cell", "ring", "part", "n")], T.StructField("shelf", T.LongType()),
                            T.StructField("center", T.BinaryType()), T.StructField("table", T.BinaryType()), T.StructField("feats", T.BinaryType()),
                            T.StructField("xs", T.ArrayType(self.types["x"])), T.StructField("rows", T.ArrayType(T.StructType([rows.schema[c] for c in names]))), T.StructField("hash", T.BinaryType())])
        hashed = self.hashes is not None

        def pack(t: pa.Table) -> pa.Table:
            t = t.sort_by("data_id")  # ties inside a block go to the smaller id
            f = _matrix(t["f"], dim)
            center = f.mean(0)
            table = []
            for v in views.values():
                d = _far(scaled(center[None], v), scaled(f, v))[0]
                table.append((d.min(), d.max()))
            one = lambda v, kind: pa.array([v], kind)
            cols = [t["w"].combine_chunks().slice(0, 1), *[t[c].combine_chunks().slice(0, 1) for c in ("cell", "ring", "part")], one(len(f), pa.int32()), t["shelf"].combine_chunks().slice(0, 1), one(center.tobytes(), pa.binary()),
                    one(np.array(table).tobytes(), pa.binary()), one(f.tobytes(), pa.binary()), _packed_list(t["x"]), _packed_list(*[t[c] for c in names], names=names), one(_hashes(t) if hashed else None, pa.binary())]
            return pa.Table.from_arrays(cols, names=out.names)

        # parts of a ring that fill a shelf (equal rows) lie on shelves of their own
        rows = rows.withColumn("shelf", F.col("shelf") * F.lit(1 << 20) + F.floor(F.col("part") * self.block_rows / self.shelf_rows))
        return rows.groupBy("w", "cell", "ring", "part").applyInArrow(pack, out)

    def _packed_queries(self, rows: DataFrame) -> DataFrame:
        dim = self.dim
        out = T.StructType([T.StructField("w", self.types["w"]), *[T.StructField(c, T.IntegerType()) for c in ("cell", "ring", "chunk", "n")], T.StructField("feats", T.BinaryType()),
                            T.StructField("xs", T.ArrayType(self.types["x"])), T.StructField("ids", T.ArrayType(self.types["query_id"])), T.StructField("hash", T.BinaryType())])
        hashed = self.hashes is not None

        def pack(t: pa.Table) -> pa.Table:
            cols = [*[t[c].combine_chunks().slice(0, 1) for c in ("w", "cell", "ring", "chunk")], pa.array([t.num_rows], pa.int32()), pa.array([_matrix(t["f"], dim).tobytes()], pa.binary()), _packed_list(t["x"]), _packed_list(t["query_id"]), pa.array([_hashes(t) if hashed else None], pa.binary())]
            return pa.Table.from_arrays(cols, names=out.names)

        return rows.groupBy("w", "cell", "ring", "chunk").applyInArrow(pack, out)

    # ---- visits
    def _bounded(self, asked: DataFrame) -> DataFrame:
        """Query blocks with ``bar``: the k-th distance in one data block of the same ring, infinite if that has fewer rows."""
        on = ["w", "cell", "ring", "several"]
        asked = asked.withColumn("several", F.floor(F.col("chunk") / SHIP).cast("int"))
        home = self.blocks.where("part = 0").select(*on[:3], "feats", "xs", "hash").join(asked.select(*[F.col(c).alias(c) for c in on]).distinct(), on[:3])
        out = T.StructType([*asked.schema.fields, T.StructField("bar", T.BinaryType())])
        k, dim, views, has_x = self.k, self.dim, self.views, self.has_x

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            bars = []
            queries, blocks = _decoded(right, left, dim, views)
            for q in queries:
                bar = np.full(len(q["f"]), np.inf)
                for d in blocks:
                    i, _, d2 = _search(q, d, np.arange(len(bar)), np.full(len(bar), np.inf), k, views, has_x)
                    last = np.zeros(len(bar))
                    np.maximum.at(last, i, d2)
                    full = np.bincount(i, minlength=len(bar)) >= k
                    bar[full] = np.minimum(bar, last)[full]
                bars.append(bar.tobytes())
            return right.append_column("bar", pa.array(bars, pa.binary()))

        n = self._tasks(self.n_blocks)
        return home.repartition(n, *on).groupBy(*on).cogroup(asked.repartition(n, *on).groupBy(*on)).applyInArrow(run, out)

    def _shelves(self) -> dict:
        """w -> (numbers, centres, radius of every view) of its shelves: a row for every ``SHELF`` bytes of data."""
        dim, views = self.dim, self.views
        out = T.StructType([T.StructField("w", self.types["w"]), T.StructField("shelf", T.LongType()), T.StructField("center", T.BinaryType()), T.StructField("outer", T.BinaryType())])

        def run(t: pa.Table) -> pa.Table:
            centers, tables = _bounds(t, dim)
            mid = centers.mean(0)
            outer = np.array([(_far(scaled(mid[None], v), scaled(centers, v))[0] + tables[:, i, 1]).max() for i, v in enumerate(views.values())])
            return pa.Table.from_arrays([*[t[c].combine_chunks().slice(0, 1) for c in ("w", "shelf")], pa.array([mid.tobytes()], pa.binary()), pa.array([outer.tobytes()], pa.binary())], names=out.names)

        found: dict = {}
        for r in self.blocks.select("w", "shelf", "center", "table").groupBy("w", "shelf").applyInArrow(run, out).collect():
            found.setdefault(r["w"], []).append((r["shelf"], np.frombuffer(r["center"]), np.frombuffer(r["outer"])))
        return {w: tuple(np.array(c) for c in zip(*sorted(v, key=lambda x: x[0]), strict=True)) for w, v in found.items()}

    def _sent(self) -> tuple[DataFrame, dict]:
        """(w, shelf, salt, n, feats, xs, ids, hash, bar): the queries of a block that a shelf can improve, once a shelf;
        and the tasks (salts) that a shelf's queries are dealt to."""
        spark, dim, views = self.spark, self.dim, self.views
        shelves = spark.sparkContext.broadcast(self._shelves())
        names = ["w", "n", "feats", "xs", "ids", "hash", "bar"]
        asked = self.asked.select(*names)

        def open_to(batch):
            for i in range(batch.num_rows):
                one = pa.Table.from_batches([batch.slice(i, 1)])
                w = one["w"][0].as_py()
                if w not in shelves.value:
                    continue
                numbers, centers, outer = shelves.value[w]
                (q,), _ = _decoded(one, None, dim, views)
                bar = np.frombuffer(one["bar"][0].as_py())
                least, slack = _least(q, centers, np.stack([np.full_like(outer, -np.inf), outer], 2), views)
                yield one, q, bar, numbers, least <= np.sqrt(bar + 10.0 ** -DIST_DIGITS)[:, None] + slack

        def count(batches):
            for b in batches:
                for one, _, _, numbers, open_ in open_to(b):
                    at = np.flatnonzero(open_.any(0))
                    yield pa.RecordBatch.from_arrays([one["w"].combine_chunks().take(pa.array(np.zeros(len(at), np.int64))), pa.array(numbers[at]), pa.array(open_[:, at].sum(0))], names=["w", "shelf", "n"])

        light = T.StructType([T.StructField("w", self.types["w"]), T.StructField("shelf", T.LongType()), T.StructField("n", T.LongType())])
        met = {(r["w"], r["shelf"]): r["n"] for r in asked.mapInArrow(count, light).groupBy("w", "shelf").agg(F.sum("n").alias("n")).collect()}
        least_tasks = -(-2 * spark.sparkContext.defaultParallelism // max(1, len(met)))
        salts = {key: max(1, -(-n // self.shelf_rows), min(least_tasks, n // QUERIES)) for key, n in met.items()}
        dealt = spark.sparkContext.broadcast(salts)
        out = T.StructType([T.StructField("w", self.types["w"]), T.StructField("shelf", T.LongType()), T.StructField("salt", T.IntegerType()), *[self.asked.schema[c] for c in names[1:]]])

        def send(batches):
            for b in batches:
                for one, q, bar, numbers, open_ in open_to(b):
                    w = one["w"][0].as_py()
                    xs, ids = one["xs"].combine_chunks()[0].values, one["ids"].combine_chunks()[0].values
                    for c in np.flatnonzero(open_.any(0)):
                        at = np.flatnonzero(open_[:, c])
                        shelf = int(numbers[c])
                        salt = zlib.crc32(q["f"][at[0]].tobytes() + str(ids[int(at[0])].as_py()).encode()) % dealt.value[w, shelf]
                        lists = [pa.ListArray.from_arrays(pa.array([0, len(at)], pa.int32()), a.take(pa.array(at))) for a in (xs, ids)]
                        hash_ = None if q["hash"] is None else q["hash"][at].tobytes()
                        yield pa.RecordBatch.from_arrays([one["w"].combine_chunks(), pa.array([shelf], pa.int64()), pa.array([salt], pa.int32()), pa.array([len(at)], pa.int32()), pa.array([q["f"][at].tobytes()], pa.binary()),
                                                          *lists, pa.array([hash_], pa.binary()), pa.array([bar[at].tobytes()], pa.binary())], names=out.names)

        return asked.mapInArrow(send, out), salts

    def _visits(self, run, schema: T.StructType, columns: tuple[str, ...]) -> DataFrame:
        """``run(blocks of a shelf, queries sent to it)`` for every shelf and salt."""
        sent, salts = self._sent()
        spark = self.spark
        kind = T.StructType([T.StructField("w", self.types["w"]), T.StructField("shelf", T.LongType()), T.StructField("salt", T.IntegerType())])
        copies = F.broadcast(spark.createDataFrame([(w, shelf, t) for (w, shelf), n in salts.items() for t in range(n)], kind))
        data = self.blocks.select("w", "shelf", *columns).join(copies, ["w", "shelf"])
        on, n = ("w", "shelf", "salt"), self._tasks(sum(salts.values()))
        return data.repartition(n, *on).groupBy(*on).cogroup(sent.repartition(n, *on).groupBy(*on)).applyInArrow(run, schema)

    def report(self) -> DataFrame:
        """One row: query_rows, blocks, pairs (of a query row and a data block), visited, share."""
        total = self.asked.groupBy("w").agg(F.sum("n").alias("q")).join(self.blocks.groupBy("w").agg(F.count("*").alias("b")), "w")
        total = total.agg(F.sum("q").alias("query_rows"), F.sum("b").alias("blocks"), F.sum(F.col("q") * F.col("b")).alias("pairs"))
        dim, views = self.dim, self.views

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            n = 0
            if left.num_rows:
                centers, tables = _bounds(left, dim)
                for q, bar in zip(_decoded(right, None, dim, views)[0], right["bar"], strict=True):
                    least, slack = _least(q, centers, tables, views)
                    n += int((least <= np.sqrt(np.frombuffer(bar.as_py()) + 10.0 ** -DIST_DIGITS)[:, None] + slack).sum())
            return pa.table({"n": pa.array([n], pa.int64())})

        seen = self._visits(run, T.StructType([T.StructField("n", T.LongType())]), ("center", "table")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("visited"))
        one = F.lit(0).alias("one")  # a row on either side
        return total.select("*", one).join(seen.select("*", one), "one").drop("one").withColumn("share", F.col("visited") / F.col("pairs"))

    def neighbours(self) -> DataFrame:
        wf = [T.StructField(self.within, self.types["w"])] if self.within else []
        schema = T.StructType([*wf, T.StructField("query_id", self.types["query_id"]), T.StructField("rank", T.IntegerType()), T.StructField("data_id", self.types["data_id"]), T.StructField("dist2", T.DoubleType()),
                               *[T.StructField(f.name, f.dataType) for f in self.carry]])
        names, n_carried, within, dim = schema.names, len(self.carry), self.within, self.dim
        k, views, has_x = self.k, self.views, self.has_x
        empty = to_arrow_schema(schema).empty_table()

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            out = []
            if not left.num_rows or not right.num_rows:
                return empty
            centers, tables = _bounds(left, dim)
            rows = [left["rows"].combine_chunks()[b].values for b in range(left.num_rows)]
            pieces, blocks = _decoded(right, left, dim, views)
            whole = {c: None if pieces[0][c] is None else np.concatenate([p[c] for p in pieces]) for c in pieces[0]}
            all_ids = pa.chunked_array([a.values for a in right["ids"]], type=right["ids"].type.value_type).combine_chunks()
            all_bars = np.concatenate([np.frombuffer(v.as_py()) for v in right["bar"]])

            def chunks():
                """Queries of one view together: a block is scaled once for all of them and its products are large."""
                for v, view in enumerate(views.values()):
                    own = np.arange(len(all_bars)) if None in views else np.flatnonzero(whole["view"] == v)
                    if len(own):
                        near = [scaled(d["f"], view) for d in blocks]
                        for lo in range(0, len(own), TOGETHER):
                            yield v, view, near, own[lo:lo + TOGETHER]

            for v, view, near, some in chunks():
                q = {c: None if whole[c] is None else whole[c][some] for c in whole}
                asked = scaled(q["f"], view)
                ids = all_ids.take(pa.array(some))
                bar = all_bars[some]
                least, slack = _least(q, centers, tables, views)
                best = np.full((len(bar), k), np.inf)
                hits = []
                for c in np.argsort(least.min(0), kind="stable"):
                    at = np.flatnonzero(least[:, c] <= np.sqrt(bar + 10.0 ** -DIST_DIGITS) + slack[:, c])
                    i, j, d2 = _search(q, blocks[c], at, bar, k, views, has_x, (v, asked, near[c]))
                    ok = d2 <= bar[i]
                    i, j, d2 = i[ok], j[ok], d2[ok]
                    if not len(i):
                        continue
                    hits.append((i, np.full(len(i), c), j, d2))
                    by = np.argsort(i, kind="stable")  # a view's queries stand together
                    own, first = np.unique(i[by], return_index=True)
                    more = np.full((len(own), k), np.inf)
                    more[np.searchsorted(own, i[by]), _nth(i[by])] = d2[by]
                    best[own] = np.sort(np.concatenate([best[own], more], 1), axis=1)[:, :k]
                    bar[own] = np.minimum(bar[own], best[own, k - 1])
                if not hits:
                    continue
                i, c, j, d2 = (np.concatenate(h) for h in zip(*hits, strict=True))
                ok = d2 <= bar[i]
                i, c, j, d2 = i[ok], c[ok], j[ok], d2[ok]
                by = np.argsort(c, kind="stable")
                i, c, j, d2 = i[by], c[by], j[by], d2[by]
                for b in np.unique(c):
                    own = c == b
                    hit = rows[b].take(pa.array(j[own])).flatten()
                    cols = [ids.take(pa.array(i[own])), pa.array(np.zeros(own.sum(), np.int32)), hit[0], pa.array(d2[own]), *hit[1:1 + n_carried]]
                    if within:
                        cols.insert(0, left["w"].combine_chunks().take(pa.array(np.zeros(own.sum(), np.int64))))
                    out.append(pa.Table.from_arrays(cols, names=names))
            return pa.concat_tables(out).combine_chunks() if out else empty

        found = self._visits(run, schema, ("center", "table", "feats", "xs", "rows", "hash"))
        w = Window.partitionBy(*([within] if within else []), "query_id").orderBy("dist2", "data_id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= self.k)
