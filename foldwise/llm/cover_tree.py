"""Hard negatives by cover trees over norm-augmented candidates.

Every candidate x gets one more coordinate, sqrt(M^2 - |x|^2), M the largest norm of the table, so all
candidates lie on one sphere and inner products with a query fall as distances grow. Candidates are dealt to shards around
pivots from a bounded sample (a large cell into several shards by hash of the id), and every shard is one cover
tree: a node's children are members far apart (the node's own centre first) that cover the node within its level's radius,
and each keeps the largest distance of its own members. Distance to a centre and that covering radius bound
the inner products below a node from both sides.

A block of anchors descends a tree best node first: nodes that lie outside the windows of all of the block's anchors, or below what
these have found already, are skipped; leaves are verified exactly, in integers. A block first visits the shard
in which its anchors live; the scores found there are the bounds with which the roots of all other shards are tested, and only trees
with an admitted root are visited. A tree is shipped once for ``SHIP`` blocks, never an anchor's list of all candidates.

Candidates of one label with one vector have equal scores for every anchor, so of such copies the smallest ids are kept, as many as can be
returned: a vector that a third of the rows share costs a few rows.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldwise.llm.work import Workspace

#: components of a shard's vectors, and rows
SHARD_VALUES, SHARD_ROWS = 1 << 18, 8192
#: anchors of a block, blocks that share a shipped tree, anchors that descend together, and roots tested at once
BLOCK, SHIP, TOGETHER, PAGE = 256, 64, 2048, 1024
#: rows of the sample that pivots are taken from, and most pivots
SAMPLE, PIVOTS = 4096, 512
LEAF, FAN, STEP = 128, 48, 1.3
NONE, FAR, NOBODY = -(1 << 62), 1 << 62, (1 << 63) - 1

TREE = "dim int, cell int, part int, n int, center binary, radius double, ids binary, labels binary, vecs binary, nodes binary, radii binary"
FOUND = "key long, w int, vec_id long, score long"


def _norms(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def _augmented(x: np.ndarray, top: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(0.0, top - _norms(x)))[:, None]], 1)


def _spread_out(x: np.ndarray, first: int, most: int, until: float = 0.0, dist: np.ndarray | None = None) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Rows far apart: ``first``, then always the row farthest from those taken, up to ``most`` or until all are
    within ``until``; each row's nearest of them and the distance."""
    dist = np.sqrt(_norms(x - x[first])) if dist is None else dist.copy()
    taken, owner = [first], np.zeros(len(x), np.int64)
    while len(taken) < most:
        far = int(dist.argmax())
        if dist[far] <= until:
            break
        d = np.sqrt(_norms(x - x[far]))
        closer = d < dist
        closer[far] = True
        owner[closer], dist[closer] = len(taken), d[closer]
        taken.append(far)
    return taken, owner, dist


def build_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order of the rows, nodes, covering radii) over augmented rows. A node is (centre, first child, number of children, first row,
    last row + 1), rows counted in the order; children stand side by side, node 0 is the root."""
    start = int(_norms(x - x.mean(0)).argmin())
    dist = np.sqrt(_norms(x - x[start]))
    order = np.arange(len(x))
    nodes, radii = [[start, 0, 0, 0, len(x)]], [float(dist.max())]
    todo = [(0, np.arange(len(x)), dist)]
    for at, rows, dist in todo:  # grows
        lo = nodes[at][3]
        order[lo:lo + len(rows)] = rows
        if len(rows) <= LEAF or radii[at] == 0:
            continue
        local = x[rows]
        centre = int(np.flatnonzero(rows == nodes[at][0])[0])
        taken, owner, near = _spread_out(local, centre, min(FAN, -(-len(rows) // (LEAF // 2))), radii[at] / STEP, dist)
        nodes[at][1:3] = [len(nodes), len(taken)]
        for j, c in enumerate(taken):
            own = np.flatnonzero(owner == j)
            todo.append((len(nodes), rows[own], near[own]))
            nodes.append([int(rows[c]), 0, 0, lo, lo + len(own)])
            radii.append(float(near[own].max()))
            lo += len(own)
    nodes = np.array(nodes, np.int32)
    place = np.empty(len(x), np.int32)
    place[order] = np.arange(len(x), dtype=np.int32)
    nodes[:, 0] = place[nodes[:, 0]]
    return order, nodes, np.array(radii)


def _products(a: np.ndarray, x: np.ndarray, safe: bool) -> np.ndarray:
    """Exact inner products over the common components (the shorter vector goes on in zeros)."""
    d = min(a.shape[1], x.shape[1])
    if safe:  # below 2**53 doubles are exact
        return np.rint(a[:, :d].astype(np.float64) @ x[:, :d].astype(np.float64).T).astype(np.int64)
    return a[:, :d].astype(np.int64) @ x[:, :d].astype(np.int64).T


class Tree:
    def __init__(self, row: dict, top: float):
        n, d = row["n"], row["dim"]
        self.top, self.d = top, d
        self.ids, self.labels = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["labels"], np.int64)
        self.vecs = np.frombuffer(row["vecs"], np.int32).reshape(n, d)
        self.nodes, self.radii = np.frombuffer(row["nodes"], np.int32).reshape(-1, 5), np.frombuffer(row["radii"])


class Anchors:
    """A block of anchors with their windows, and the best candidates found. ``bar`` holds scores below which
    nothing is wanted."""

    def __init__(self, row: dict, same: bool, k: int, top: float):
        m, d = row["m"], row["dim"]
        self.ids, self.keys, self.labels = (np.frombuffer(row[c], np.int64) for c in ("ids", "keys", "labels"))
        self.vecs = np.frombuffer(row["vecs"], np.int32).reshape(m, d)
        self.lo, self.hi = (np.frombuffer(row[c], np.int64).reshape(m, -1) for c in ("lo", "hi"))
        self.bar = np.frombuffer(row["bar"], np.int64).reshape(m, -1).copy() if row.get("bar") is not None else self.lo.copy()
        self.same, self.k, self.top = same, k, top
        self.score = np.full((*self.lo.shape, k), NONE, np.int64)
        self.vec = np.full((*self.lo.shape, k), NOBODY, np.int64)
        self.safe = top < 1 << 52

    def bounds(self, who: np.ndarray, centers: np.ndarray, radii: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) of the inner products below nodes."""
        q = self.vecs[who]
        s = _products(q, centers, self.safe).astype(np.float64)
        sq = _norms(q[:, :centers.shape[1]].astype(np.float64))[:, None]
        reach = np.sqrt(sq) * radii
        both = sq + self.top
        dist = np.sqrt(np.maximum(0.0, both - 2 * s))
        slack = 1e-9 * both + 1e-6
        upper = np.minimum(s + reach, (both - np.maximum(0.0, dist - radii) ** 2) / 2) + slack
        lower = np.maximum(s - reach, (both - (dist + radii) ** 2) / 2) - slack
        return lower, upper

    def wanted(self, who: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        """For which nodes (columns) has an anchor a window that meets lower..upper above what it has found?"""
        out = np.zeros(lower.shape, bool)
        for w in range(self.lo.shape[1]):
            hi, bar = self.hi[who, w][:, None], self.bar[who, w][:, None]
            out |= (lower <= hi) & (np.minimum(upper, hi) >= bar)
        return out

    def verify(self, who: np.ndarray, t: Tree, lo: int, hi: int) -> None:
        s = _products(self.vecs[who], t.vecs[lo:hi], self.safe)
        ids = t.ids[lo:hi]
        fits = (self.labels[who][:, None] == t.labels[None, lo:hi]) == self.same
        if self.same:
            fits &= self.ids[who][:, None] != ids
        ok = fits[:, None, :] & (s[:, None, :] <= self.hi[who][:, :, None]) & (s[:, None, :] >= self.bar[who][:, :, None])
        i, w = np.nonzero(ok.any(2))
        if not len(i):
            return
        rows, ok, s = who[i], ok[i, w], s[i]
        score = np.concatenate([self.score[rows, w], np.where(ok, s, NONE)], 1)
        vec = np.concatenate([self.vec[rows, w], np.where(ok, ids, NOBODY)], 1)
        best = np.lexsort((vec, -score), axis=1)[:, :self.k]
        at = np.arange(len(i))[:, None]
        self.score[rows, w], self.vec[rows, w] = score[at, best], vec[at, best]
        self.bar[rows, w] = np.maximum(self.bar[rows, w], self.score[rows, w, -1])

    def descend(self, t: Tree) -> int:
        """Best-first search of a tree; the number of leaves verified."""
        everyone = np.arange(len(self.ids))
        heap: list = []
        n = leaves = 0

        def push(first: int, count: int, who: np.ndarray) -> None:
            nonlocal n
            centers = t.vecs[t.nodes[first:first + count, 0]]
            lower, upper = self.bounds(who, centers, t.radii[first:first + count])
            wanted = self.wanted(who, lower, upper)
            for j in range(count):
                in_ = np.flatnonzero(wanted[:, j])
                if len(in_):
                    n += 1
                    heapq.heappush(heap, (-float(upper[in_, j].max()), n, first + j, who[in_], lower[in_, j], upper[in_, j]))

        push(0, 1, everyone)
        while heap:
            _, _, node, who, lower, upper = heapq.heappop(heap)
            who = who[self.wanted(who, lower[:, None], upper[:, None])[:, 0]]  # bars have risen meanwhile
            if not len(who):
                continue
            _, first, count, lo, hi = t.nodes[node]
            if count:
                push(int(first), int(count), who)
            else:
                leaves += 1
                self.verify(who, t, int(lo), int(hi))
        return leaves

    def found(self) -> pa.RecordBatch:
        i, w, k = np.nonzero(self.vec != NOBODY)
        return pa.RecordBatch.from_arrays([pa.array(self.keys[i]), pa.array(w.astype(np.int32)), pa.array(self.vec[i, w, k]), pa.array(self.score[i, w, k])], names=["key", "w", "vec_id", "score"])


def _matrix(col, d: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(len(col), d)


def _long(col) -> np.ndarray:
    return col.to_numpy(zero_copy_only=False) if isinstance(col, pa.Array) else col.combine_chunks().to_numpy(zero_copy_only=False)


def _pivots(rows: DataFrame, n_rows: int, top: float, widest: int) -> dict[int, np.ndarray]:
    """For each dimension the pivots, as far apart as a bounded sample allows. At most ``SAMPLE`` rows
    and 32 MB reach the driver; dimensions that the sample misses have no pivots and are one cell."""
    want = max(1, min(SAMPLE, (32 << 20) // (8 * max(1, widest))))
    part = F.pmod(F.xxhash64("vec_id", "label"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, want / max(1, n_rows)))
    found = rows.where(part).orderBy("vec_id", "label").select("vec").limit(2 * want).toArrow()["vec"]
    found = found.combine_chunks() if found.num_chunks else pa.array([], pa.list_(pa.int32()))
    sizes = np.diff(found.offsets.to_numpy()).astype(np.int64) if len(found) else np.zeros(0, np.int64)
    out: dict[int, np.ndarray] = {}
    for d in np.unique(sizes):
        x = _matrix(found.take(pa.array(np.flatnonzero(sizes == d))), int(d)).astype(np.float64)
        share = n_rows * len(x) / max(1, len(sizes))
        most = int(min(PIVOTS, max(1, -(-share // _shard_rows(int(d))))))
        x = _augmented(x, top)
        out[int(d)] = x[_spread_out(x, 0, most)[0]]
    return out


def _shard_rows(d: int) -> int:
    return max(1, min(SHARD_ROWS, SHARD_VALUES // max(1, d)))


def _celled(rows: DataFrame, pivots, top: float) -> DataFrame:
    """``rows`` with dim and cell, the pivot with the nearest augmented vector."""
    cols = rows.columns

    def run(batches):
        for b in batches:
            vec = b.column(cols.index("vec"))
            size = np.diff(vec.offsets.to_numpy(zero_copy_only=False))
            cell = np.zeros(len(size), np.int32)
            for d in np.unique(size):
                at = np.flatnonzero(size == d)
                p = pivots.value.get(int(d))
                for lo in range(0, len(at) if p is not None else 0, 2048):
                    some = at[lo:lo + 2048]
                    cell[some] = (_augmented(_matrix(vec.take(pa.array(some)), int(d)).astype(np.float64), top) @ p.T).argmax(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(size.astype(np.int32)), pa.array(cell)], names=[*cols, "dim", "cell"])

    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(run, f"{kinds}, dim int, cell int")


def _trees(rows: DataFrame, top: float) -> DataFrame:
    def build(t: pa.Table) -> pa.Table:
        d, ids = t["dim"][0].as_py(), _long(t["vec_id"])
        by_id = np.argsort(ids, kind="stable")  # the same tree from any order of the rows
        x = _matrix(t["vec"], d)[by_id]
        order, nodes, radii = build_tree(_augmented(x.astype(np.float64), top))
        cols = {"dim": d, "cell": t["cell"][0].as_py(), "part": t["part"][0].as_py(), "n": len(ids), "center": x[order][nodes[0, 0]].tobytes(), "radius": float(radii[0]),
                "ids": ids[by_id][order].tobytes(), "labels": _long(t["label"])[by_id][order].tobytes(), "vecs": x[order].tobytes(), "nodes": nodes.tobytes(), "radii": radii.tobytes()}
        kinds = [pa.int32()] * 4 + [pa.binary(), pa.float64()] + [pa.binary()] * 5
        return pa.table({k: pa.array([v], kind) for (k, v), kind in zip(cols.items(), kinds, strict=True)})

    return rows.groupBy("dim", "cell", "part").applyInArrow(build, TREE)


PACKED = "dim int, cell int, part int, chunk int, m int, ids binary, keys binary, labels binary, vecs binary, lo binary, hi binary"


def _packed(anchors: DataFrame) -> DataFrame:
    """Blocks of anchors (key, vec_id, label, vec, lo, hi, dim, cell, part, chunk); ``lo`` and ``hi`` are arrays, one value a window."""

    def pack(t: pa.Table) -> pa.Table:
        d = t["dim"][0].as_py()
        cols = {c: t[c][0].as_py() for c in ("dim", "cell", "part", "chunk")} | {"m": t.num_rows, "ids": _long(t["vec_id"]).tobytes(), "keys": _long(t["key"]).tobytes(), "labels": _long(t["label"]).tobytes(),
                "vecs": _matrix(t["vec"], d).tobytes()} | {c: _long(t[c].combine_chunks().flatten()).astype(np.int64).tobytes() for c in ("lo", "hi")}
        return pa.table({k: pa.array([v], pa.int32() if isinstance(v, int) else pa.binary()) for k, v in cols.items()})

    return anchors.groupBy("dim", "cell", "part", "chunk").applyInArrow(pack, PACKED)


def _visit(pairs: DataFrame, trees: DataFrame, n_trees: int, n_salts: int, same: bool, k: int, top: float, schema: str, emit, together: int) -> DataFrame:
    """``emit(block row, anchors)`` for every tree of ``pairs`` (t_dim, t_cell, t_part beside a block's columns) and its
    blocks, with up to ``together`` anchors put into one descent."""
    on = ["t_dim", "t_cell", "t_part", "salt"]
    own = ["dim", "cell", "part"]
    pairs = pairs.withColumn("salt", F.pmod(F.xxhash64(*own, "chunk"), F.lit(n_salts)).cast("int"))
    wanted = pairs.select(*[F.col(f"t_{c}").alias(c) for c in own], F.col("salt").alias("of")).distinct()
    n = _tasks(trees.sparkSession, n_trees * n_salts)
    shipped = trees.join(wanted, own).repartition(n, *own, "of")
    lists = ["ids", "keys", "labels", "vecs", "lo", "hi", "bar"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        tree = Tree(left.slice(0, 1).to_pylist()[0], top) if left.num_rows else None
        rows: list[dict] = []
        for i in range(right.num_rows + 1):
            row = right.slice(i, 1).to_pylist()[0] if i < right.num_rows else None
            if rows and (row is None or row["dim"] != rows[0]["dim"] or sum(r["m"] for r in rows) + row["m"] > together):
                one = rows[0] if len(rows) == 1 else rows[0] | {"m": sum(r["m"] for r in rows)} | {c: b"".join(r[c] for r in rows) for c in lists if rows[0].get(c) is not None}
                a = Anchors(one, same, k, top)
                if tree is not None:
                    a.descend(tree)
                out.append(emit(one, a))
                rows = []
            rows.append(row)
        kinds = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in schema.split(", "))])
        return pa.Table.from_batches([b.cast(kinds) for b in out], kinds)

    return shipped.groupBy(*own, "of").cogroup(pairs.repartition(n, *on).groupBy(*on)).applyInArrow(run, schema)


def _tasks(spark, groups: int) -> int:
    """Tasks for groups that are small in bytes and long in work, which adaptive execution would put together."""
    return max(1, min(groups, max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)))


def _search(anchors: DataFrame, trees: DataFrame, ws: Workspace, same: bool, k: int, top: float) -> DataFrame:
    """FOUND: at least the k best candidates of every anchor's window, from two rounds of visits."""
    blocks = ws.keep(_packed(anchors))
    n_blocks, n_trees = blocks.count(), trees.count()
    names = [c.split()[0] for c in PACKED.split(", ")]
    first = PACKED + ", bar binary, score binary, vec binary"

    def with_bar(row: dict, a: Anchors) -> pa.RecordBatch:
        vals = [row[c] for c in names] + [a.bar.tobytes(), a.score.tobytes(), a.vec.tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([v], pa.int32() if isinstance(v, int) else pa.binary()) for v in vals], names=[*names, "bar", "score", "vec"])

    salts = max(1, -(-n_blocks // SHIP))
    home = blocks.select("*", F.col("dim").alias("t_dim"), F.col("cell").alias("t_cell"), F.col("part").alias("t_part"))
    blocks = ws.keep(_visit(home, trees, n_trees, salts, same, k, top, first, with_bar, 0))
    own = ["dim", "cell", "part", "chunk"]

    # roots of all other trees against the bars, a page of roots and a block at a time
    roots = trees.select("dim", "cell", "part", "center", "radius")
    n_pages = max(1, -(-n_trees // PAGE))
    pages = roots.groupBy(F.pmod(F.xxhash64("dim", "cell", "part"), F.lit(n_pages)).cast("int").alias("page")).agg(F.collect_list(F.struct("*")).alias("roots"))  # about PAGE rows a group
    tested = blocks.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1)))).join(pages, "page").drop("page", "score", "vec")
    at = {c: i for i, c in enumerate(tested.columns)}

    def admitted(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = {c: b.column(j)[i].as_py() for c, j in at.items() if c != "roots"}
                a = Anchors(row, same, k, top)
                who, out = np.arange(len(a.ids)), []
                for r in b.column(at["roots"])[i].as_py():
                    if [r[c] for c in own[:3]] == [row[c] for c in own[:3]]:
                        continue  # home
                    lower, upper = a.bounds(who, np.frombuffer(r["center"], np.int32).reshape(1, r["dim"]), np.array([r["radius"]]))
                    if a.wanted(who, lower, upper).any():
                        out.append([*(row[c] for c in own), *(r[c] for c in own[:3])])
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in zip(*out, strict=True)], names=[*own, "t_dim", "t_cell", "t_part"])

    pairs = ws.keep(tested.mapInArrow(admitted, "dim int, cell int, part int, chunk int, t_dim int, t_cell int, t_part int"))
    more = _visit(pairs.join(blocks.drop("score", "vec"), own), trees, n_trees, salts, same, k, top, FOUND, lambda row, a: a.found(), TOGETHER)

    def at_home(batches):
        for b in batches:
            for row in b.to_pylist():
                a = Anchors(row, same, k, top)
                a.score, a.vec = (np.frombuffer(row[c], np.int64).reshape(a.score.shape) for c in ("score", "vec"))
                yield a.found()

    best = Window.partitionBy("key", "w").orderBy(F.col("score").desc(), "vec_id")
    return more.unionAll(blocks.mapInArrow(at_home, FOUND)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def mine_hard_negatives(rows: DataFrame, *, every: int = 100, positives: int = 5, negatives: int = 5, low: int = 80) -> DataFrame:
    """``rows``: vec_id long, label long, vec array<int> without nulls. Anchors are the rows whose vec_id is divisible by
    ``every``, their positives the ``positives`` rows of the same label with the highest inner products, ties by smaller id.
    For each, the ``negatives`` best rows of other labels with low * positive_score <= 100 * negative_score <= 100 * positive_score:
    anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Other rows are those with another vec_id; rows that repeat an id with the same label and vector are one candidate, with
    other labels or vectors several, and each anchor row has results of its own. Of vectors of unequal length the shorter goes on in
    zeros, so an empty one has product 0 with all. An anchor without positives, and a positive without negatives in its window (all
    with a negative score), have no row. An empty table gives an empty result. Squared norms above 2**60 raise a
    ValueError, since scores wouldn't fit 64 bits."""
    if low > 100:
        raise ValueError("low is a percentage of the positive's score, at most 100")
    spark = rows.sparkSession
    ws = Workspace(spark, "cover")
    rows = rows.select("vec_id", "label", "vec")
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    n_rows, top, widest = rows.agg(F.count("*"), F.coalesce(F.max(square), F.lit(0.0)), F.coalesce(F.max(F.size("vec")), F.lit(0))).first()
    if top > 1 << 60:
        raise ValueError("squared norms above 2**60")
    copies = Window.partitionBy("label", "vec").orderBy("vec_id")
    distinct = rows.where(F.col("vec_id") % every != 0).unionAll(rows.where(F.col("vec_id") % every == 0).distinct())
    few = distinct.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= max(positives + 1, negatives)).drop("copy")
    pivots = spark.sparkContext.broadcast(_pivots(rows, n_rows, top, widest))
    cand = ws.keep(_celled(few, pivots, top))
    size = F.greatest(F.lit(1), F.least(F.lit(SHARD_ROWS), F.floor(F.lit(SHARD_VALUES) / F.greatest(F.lit(1), F.col("dim")))))
    cells = cand.groupBy("dim", "cell").agg(F.count("*").alias("n")).select("dim", "cell", F.ceil(F.col("n") / size).alias("parts"))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int")
    n_shards = cells.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
    shards = cand.join(cells, ["dim", "cell"]).withColumn("part", part).drop("parts")
    trees = ws.keep(_trees(shards.repartition(_tasks(spark, n_shards), "dim", "cell", "part"), top))

    anchors = _celled(rows.where(F.col("vec_id") % every == 0).withColumn("key", F.monotonically_increasing_id()), pivots, top)
    anchors = ws.keep(anchors.join(cells, ["dim", "cell"]).withColumn("part", part).drop("parts"))
    chunks = anchors.groupBy("dim", "cell", "part").agg(F.ceil(F.count("*") / BLOCK).alias("chunks"))
    anchors = anchors.join(chunks, ["dim", "cell", "part"]).withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int")).drop("chunks")

    near = _search(anchors.withColumns({"lo": F.array(F.lit(NONE)), "hi": F.array(F.lit(FAR))}), trees, ws, True, positives, top)
    near = ws.keep(near.select("key", (F.col("rank") - 1).alias("w"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    # every anchor has as many windows as can be; those without a positive are empty
    wins = near.groupBy("key").agg(F.map_from_entries(F.collect_list(F.struct("w", "positive_score"))).alias("p"))
    per = F.sequence(F.lit(0), F.lit(positives - 1))
    score = lambda w: F.try_element_at("p", w)
    wins = wins.select("key", F.transform(per, lambda w: F.coalesce(F.ceil(score(w).cast("decimal(20,0)") * F.lit(low) / 100).cast("long"), F.lit(FAR))).alias("lo"),
                       F.transform(per, lambda w: F.coalesce(score(w), F.lit(NONE))).alias("hi"))
    far = _search(anchors.join(wins, "key"), trees, ws, False, negatives, top)
    out = far.join(near, ["key", "w"]).join(anchors.select("key", F.col("vec_id").alias("anchor_id")), "key")
    return ws.close(out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def prepared(embeddings: DataFrame) -> DataFrame:
    """Rows that take part: vec_id, label, embedding and all its components not null and finite. Where vec_id is divisible by
    7 the label becomes (label + 1) % 10; each component x becomes floor(256 * x), x as a double."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    if_7 = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    # beyond the bound on norms; keeps the cast within 32 bits
    cut = lambda v: F.greatest(F.least(F.floor(v * 256), F.lit((1 << 31) - 1)), F.lit(-(1 << 31) + 1)).cast("int")
    return embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), if_7.cast("long").alias("label"), F.transform(x, cut).alias("vec"))


def op11_cover_tree_negatives(spark, sf_dir: str) -> DataFrame:
    return mine_hard_negatives(prepared(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = e.label AS same, e.vec_id, list_inner_product(a.v, e.v)::BIGINT AS score
    FROM e AS a JOIN e ON a.vec_id % 100 = 0 AND a.vec_id <> e.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
