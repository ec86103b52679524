"""Benchmark decontamination by suffix arrays of the training text.

A task gathers whole texts up to a bounded number of bytes (one longer text alone) into a shard and builds the
shard's suffix array over words. Every suffix of the benchmark's items is binary-searched in every
shard: the neighbours of its place give its longest verbatim match, and, if that is as long as
a window, the interval of the array that begins with the window gives all of the window's places.
Documents with such places are affected.

Words get ids of the benchmark's vocabulary (matched by a 64-bit hash of their bytes); a word
that no item has, and a text's end, are 0 and equal to nothing, so suffixes end there and suffixes that begin there
can't match and aren't kept. As many ids as fit 64 bits form a key; the array is sorted by keys and, where these tie, by
prefix doubling up to the length of the longest item.

The benchmark is broadcast in blocks of a bounded size; one block, the usual case, needs no exchange at
all. With more, every block is a pass, and places are put together by row.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.plainwords import SQL_WORDS, plain
from foldwise.llm.textkit import Words, buffers, pieces, release, runs
from foldwise.llm.work import Workspace

#: bytes of text of a shard, and of the items of a block (a longer text or item is alone)
SHARD = 2 << 20
BLOCK = 4 << 20
#: most values in an output batch of lists
LISTED = 1 << 20

_U = np.uint64


def _keys(seq: np.ndarray, bits: int, w: int) -> np.ndarray:
    """The next ``w`` ids from every position, 0 from the first 0 on; two more zero keys at the end."""
    n = len(seq)
    padded = np.concatenate([seq, np.zeros(w, seq.dtype)])
    alive, key = np.ones(n, bool), np.zeros(n + 2, _U)
    for j in range(w):
        x = padded[j:j + n]
        alive &= x > 0
        key[:n] = (key[:n] << _U(bits)) | np.where(alive, x, 0).astype(_U)
    return key


def suffix_array(seq: np.ndarray, keys: np.ndarray, bits: int, w: int, depth: int) -> np.ndarray:
    """Positions of ``seq`` that aren't 0, sorted by the ids from there to the next 0 (at least the first ``depth``)."""
    at = np.flatnonzero(seq)
    sub = np.argsort(keys[at])
    order, k = at[sub], keys[at][sub]
    if not len(order):
        return order

    def groups(k):
        new = np.concatenate([[True], k[1:] != k[:-1]])
        first = np.maximum.accumulate(np.where(new, np.arange(len(k)), 0))
        alone = new & np.concatenate([new[1:], [True]])
        return first, ~alone

    first, tied = groups(k)
    rank = np.zeros(len(seq) + 2, np.int64)
    rank[order] = first + 1
    n = len(seq)
    left = np.minimum.accumulate(np.where(seq == 0, np.arange(n), n)[::-1])[::-1][order] - order  # ids before the next 0
    h = w
    while h < depth:
        idx = np.flatnonzero(tied & (left >= h))  # suffixes that have ended earlier are equal
        if not len(idx):
            break
        pos, after = order[idx], rank[order[idx] + h]
        k = (first[idx].astype(_U) << _U(32)) | after.astype(_U)
        sub = np.argsort(k)
        order[idx], left[idx] = pos[sub], left[idx][sub]
        start, more = groups(k[sub])
        first[idx] = idx[start]
        rank[order[idx]] = first[idx] + 1
        tied = np.zeros(len(order), bool)
        tied[idx] = more
        h *= 2
    return order


class Items:
    """A block of benchmark items: vocabulary, suffixes, and distinct windows with their items."""

    def __init__(self, names: list[str | None], texts: list[str | None], window: int):
        data, off = buffers(pa.array(texts, pa.large_string()))
        w = Words(plain(data), off, 0, len(texts))
        h = w.hashes()
        self.vocab, ids = np.unique(h, return_inverse=True)
        self.bits = max(1, len(self.vocab).bit_length())
        self.w = 64 // self.bits
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.vocab >> _U(44)).astype(np.int64)] = True
        self.seq = np.zeros(len(h) + len(texts), np.int64)
        place = np.arange(len(h)) + w.doc
        self.seq[place] = ids + 1
        self.keys = _keys(self.seq, self.bits, self.w)
        self.start = place  # every suffix
        self.size = (w.first[1:][w.doc] - np.arange(len(h))).astype(np.int64)
        self.item, self.rows = w.doc, names
        self.depth = int(w.count.max(initial=0))
        self.names = sorted({n for n in names if n is not None})
        code = {n: i for i, n in enumerate(self.names)}
        codes = np.array([code.get(n, -1) for n in names], np.int64)
        # windows, one for each distinct content
        long = self.size >= window
        whole = (w.count[w.doc] < window) & (np.arange(len(h)) == w.first[:-1][w.doc]) if len(h) else np.zeros(0, bool)
        suffix = np.flatnonzero(long | whole)
        size = np.minimum(self.size[suffix], window)
        padded = np.concatenate([self.seq, np.zeros(window, np.int64)])
        grid = np.stack([np.where(j < size, padded[self.start[suffix] + j], 0) for j in range(window)], 1) if len(suffix) else np.zeros((0, window), np.int64)
        _, one, which = np.unique(grid, axis=0, return_index=True, return_inverse=True)
        which = which.reshape(-1)
        self.win_suffix, self.win_size = suffix[one], size[one]
        pair = np.unique(np.stack([which, codes[self.item[suffix]]], 1)[codes[self.item[suffix]] >= 0], axis=0) if len(suffix) else np.zeros((0, 2), np.int64)
        self.win_items = pair[:, 1]
        self.win_off = np.searchsorted(pair[:, 0], np.arange(len(one) + 1))

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        out = np.zeros(len(hashes), np.int64)
        at = np.flatnonzero(self.maybe[(hashes >> _U(44)).astype(np.int64)])
        if len(self.vocab) and len(at):
            k = np.searchsorted(self.vocab, hashes[at])
            ok = self.vocab[np.minimum(k, len(self.vocab) - 1)] == hashes[at]
            out[at[ok]] = k[ok] + 1
        return out

    def items_of(self, windows: np.ndarray) -> np.ndarray:
        """Codes of the items that have any of the windows, ascending (names are sorted by code)."""
        return np.unique(np.concatenate([self.win_items[self.win_off[x]:self.win_off[x + 1]] for x in windows])) if len(windows) else np.zeros(0, np.int64)


class Shard:
    """The suffix array of the texts ``lo..hi`` of a batch."""

    def __init__(self, items: Items, data: np.ndarray, off: np.ndarray, lo: int, hi: int):
        self.items = items
        w = Words(plain(data[off[lo]:off[hi]]), off[lo:hi + 1] - off[lo], 0, hi - lo)
        self.count, self.n_docs = w.count, hi - lo
        self.begin = w.first[:-1] + np.arange(self.n_docs)  # position of each text's first word
        self.seq = np.zeros(len(w.start) + self.n_docs, np.int64)
        self.seq[np.arange(len(w.start)) + w.doc] = items.ids(w.hashes())
        self.keys = _keys(self.seq, items.bits, items.w)
        self.order = suffix_array(self.seq, self.keys, items.bits, items.w, items.depth)
        self.first_key = self.keys[self.order]

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.begin, pos, "right") - 1

    def _bisect(self, level: int, lo: np.ndarray, hi: np.ndarray, want: np.ndarray, right: bool) -> np.ndarray:
        if not level:
            return np.searchsorted(self.first_key, want, "right" if right else "left")
        lo, hi = lo.copy(), hi.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                return lo
            mid = (lo[open_] + hi[open_]) >> 1
            k = self.keys[self.order[mid] + level * self.items.w]
            up = k <= want[open_] if right else k < want[open_]
            lo[open_[up]] = mid[up] + 1
            hi[open_[~up]] = mid[~up]

    def find(self, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the ``size`` ids from each ``start`` of the items: length of the longest match here, and the interval of
        the array that begins with all of them, or one place of the longest match if there is none."""
        t, w, bits = self.items, self.items.w, self.items.bits
        longest, left, right = (np.zeros(len(start), np.int64) for _ in range(3))
        act = np.arange(len(start)) if len(self.order) else np.zeros(0, np.int64)
        lo, hi = np.zeros(len(act), np.int64), np.full(len(act), len(self.order))
        level = 0
        while len(act):
            want = t.keys[start[act] + level * w]
            r = np.minimum(w, size[act] - level * w)
            low = (_U(1) << (_U(bits) * (w - r).astype(_U))) - _U(1)
            want &= ~low  # a window ends inside its key
            a = self._bisect(level, lo, hi, want, False)
            b = self._bisect(level, lo, hi, want | low, True)
            none = a >= b
            if none.any():
                best, place = np.zeros(int(none.sum()), np.int64), np.minimum(a[none], hi[none] - 1)
                for side in (a[none] - 1, a[none]):
                    inside = (side >= lo[none]) & (side < hi[none])
                    x = self.keys[self.order[np.where(inside, side, 0)] + level * w] ^ want[none]
                    same, alive = np.zeros(len(x), np.int64), inside.copy()
                    for j in range(w):
                        alive &= ((x >> _U(bits * (w - 1 - j))) == 0) & (j < r[none])
                        same += alive
                    place = np.where(same > best, side, place)
                    best = np.maximum(best, same)
                longest[act[none]] = level * w + best
                left[act[none]] = right[act[none]] = place
            done = ~none & (size[act] <= (level + 1) * w)
            longest[act[done]] = size[act[done]]
            left[act[done]], right[act[done]] = a[done], b[done]
            go = ~none & ~done
            act, lo, hi = act[go], a[go], b[go]
            level += 1
        return longest, left, right

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """(position, distinct window) of all places of all windows. At a position stands at most one window of a length."""
        t = self.items
        longest, _, _ = self.find(t.start, t.size)  # every suffix
        there = np.flatnonzero(longest[t.win_suffix] >= t.win_size)
        _, a, b = self.find(t.start[t.win_suffix[there]], t.win_size[there])
        n = b - a
        pos = self.order[np.repeat(a - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
        return pos, np.repeat(there, n)

    def hits(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position is inside a place, and (text, window) pairs ordered by text)."""
        pos, win = self.places()
        n = len(self.seq)
        delta = np.bincount(pos, minlength=n + 1) - np.bincount(pos + self.items.win_size[win], minlength=n + 1)
        pair = np.unique(self.doc_of(pos) * max(1, len(self.items.win_size)) + win)
        return np.cumsum(delta[:n]) > 0, pair // max(1, len(self.items.win_size)), pair % max(1, len(self.items.win_size))


RESULT = "struct<n_words: bigint, n_hit: bigint, n_items: bigint, items_sha256: string, contaminated: boolean>"


def _digest(names) -> str:
    return hashlib.sha256(",".join(names).encode()).hexdigest()


def _whole(items: Items, text: pa.Array, known: dict) -> pa.Array:
    """RESULT of each text, for a benchmark of one block. ``known``: digests of sets of windows seen before."""
    data, off = buffers(text)
    out: list[list] = [[], [], [], []]
    none = (0, _digest([]))
    for lo, hi in pieces(off, SHARD):
        s = Shard(items, data, off, lo, hi)
        hit, doc, win = s.hits()
        out[0].append(s.count)
        out[1].append(np.bincount(s.doc_of(np.flatnonzero(hit)), minlength=s.n_docs))
        found = [none] * s.n_docs
        at = np.searchsorted(doc, np.arange(s.n_docs + 1))
        for d in np.unique(doc):
            mine = win[at[d]:at[d + 1]]
            key = hashlib.sha256(mine.tobytes()).digest()
            if key not in known:
                if len(known) >= 10_000:  # forgets, and works out again
                    known.clear()
                codes = items.items_of(mine)
                known[key] = (len(codes), _digest(items.names[c] for c in codes))
            found[d] = known[key]
        out[2] += [x[0] for x in found]
        out[3] += [x[1] for x in found]
    n_words, n_hit = (np.concatenate([np.zeros(0, np.int64), *x]).astype(np.int64) for x in out[:2])
    release()
    cols = [pa.array(n_words), pa.array(n_hit), pa.array(out[2], pa.int64()), pa.array(out[3], pa.string()), pa.array(n_hit > 0)]
    return pa.StructArray.from_arrays(cols, names=["n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def _parts(items: Items, batches):
    """(row_key, spans, names) of each text with a place of a window of this block."""
    for batch in batches:
        key, (data, off) = batch.column(0).to_numpy(zero_copy_only=False), buffers(batch.column(1))
        rows: list[tuple] = []
        size = 0

        def full():
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.list_(pa.string()))], names=["row_key", "spans", "names"])

        for lo, hi in pieces(off, SHARD):
            s = Shard(items, data, off, lo, hi)
            hit, doc, win = s.hits()
            a, b = runs(hit, np.append(s.begin, len(s.seq)))
            own, at = s.doc_of(a), np.searchsorted(doc, np.arange(s.n_docs + 1))
            cut = np.searchsorted(own, np.arange(s.n_docs + 1))
            for d in np.unique(doc):
                span = np.stack([a[cut[d]:cut[d + 1]], b[cut[d]:cut[d + 1]]], 1) - s.begin[d]
                rows.append((int(key[lo + d]), span.reshape(-1), [items.names[c] for c in items.items_of(win[at[d]:at[d + 1]])]))
                size += 2 * len(span) + len(rows[-1][2])
                if size > LISTED:
                    yield full()
                    rows, size = [], 0
        if rows:
            yield full()


def _joined(spans: pa.Array, names: pa.Array) -> pa.Array:
    """(n_hit, n_items, items_sha256) from the lists of several blocks."""
    out = []
    for s, n in zip(spans, names, strict=True):
        span = np.array(s.as_py(), np.int64).reshape(-1, 2)
        span = span[np.argsort(span[:, 0])]
        reach = np.maximum.accumulate(np.concatenate([[0], span[:, 1]]))[:-1]
        ids = sorted(set(n.as_py()))
        out.append({"n_hit": int(np.maximum(0, span[:, 1] - np.maximum(span[:, 0], reach)).sum()), "n_items": len(ids), "items_sha256": _digest(ids)})
    return pa.array(out, pa.struct([("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string())]))


def _blocks(benchmark: DataFrame, window: int, limit: int):
    """The benchmark as broadcast blocks, one after the other."""
    spark = benchmark.sparkSession
    rows = benchmark.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("string").alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-2 * total // limit)) if total > limit else 1

    def block(i: int):
        part = rows.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == i).collect()
        return spark.sparkContext.broadcast(Items([r["name"] for r in part], [r["text"] for r in part], window))

    return n, block


def longest_matches(docs: DataFrame, benchmark: DataFrame, *, at_least: int = 1, block: int = BLOCK) -> DataFrame:
    """For every suffix of every item its longest verbatim match in ``docs``: item_id (string), item_word (its first word, from 0),
    n_words (of the match), doc_id and doc_word (one of its places). Suffixes that match fewer than ``at_least`` words
    have no row. Rows with the same item_id are items of their own here. Nulls and empty tables give no rows."""
    n, get = _blocks(benchmark, 1, block)
    ws = Workspace(docs.sparkSession, "matches")
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def one(i: int) -> DataFrame:
        items = get(i)

        def run(batches):
            t: Items = items.value
            best, doc, word = np.zeros(len(t.start), np.int64), np.zeros(len(t.start), np.int64), np.zeros(len(t.start), np.int64)
            nulls = np.zeros(len(t.start), bool)
            for batch in batches:
                unknown = np.asarray(batch.column(0).is_null())
                ids, (data, off) = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False), buffers(batch.column(1))
                for lo, hi in pieces(off, SHARD):
                    s = Shard(t, data, off, lo, hi)
                    size, left, _ = s.find(t.start, t.size)
                    more = np.flatnonzero(size > best)
                    if not len(more):
                        continue
                    pos = s.order[left[more]]
                    d = s.doc_of(pos)
                    best[more], doc[more], word[more], nulls[more] = size[more], ids[lo + d], pos - s.begin[d], unknown[lo + d]
            out = np.flatnonzero(best >= max(1, at_least))
            yield pa.RecordBatch.from_arrays([pa.array(out), pa.array(best[out]), pa.array(doc[out], mask=nulls[out]), pa.array(word[out])], names=["suffix", "n_words", "doc_id", "doc_word"])

        def named(batches):
            t: Items = items.value
            ends = np.flatnonzero(np.diff(t.item, prepend=-1))
            for b in batches:
                k = b.column(0).to_numpy(zero_copy_only=False)
                item = t.item[k]
                first = ends[np.searchsorted(t.item[ends], item)]
                yield pa.RecordBatch.from_arrays([pa.array([t.rows[x] for x in item], pa.string()), pa.array(k - first), *b.columns[1:]], names=["item_id", "item_word", "n_words", "doc_id", "doc_word"])

        found = texts.mapInArrow(run, "suffix long, n_words long, doc_id long, doc_word long").groupBy("suffix").agg(F.max(F.struct("n_words", "doc_id", "doc_word")).alias("m")).select("suffix", "m.*")
        out = ws.keep(found.mapInArrow(named, "item_id string, item_word long, n_words long, doc_id long, doc_word long"))
        items.unpersist()
        return out

    return ws.close(reduce(DataFrame.unionAll, [one(i) for i in range(n)]))


def _column(items, text: Column) -> Column:
    known: dict = {}
    return F.arrow_udf(lambda t: _whole(items.value, t, known), RESULT)(text.cast("string"))


def _keyed(rows: DataFrame, benchmark: DataFrame, window: int, n: int, get, ws: Workspace) -> DataFrame:
    """(row_key, n_hit, n_items, items_sha256) of the affected rows, block by block."""
    tables = []
    for i in range(n):
        items = get(i)
        tables.append(ws.keep(rows.select("row_key", "text").mapInArrow(lambda b, items=items: _parts(items.value, b), "row_key long, spans array<long>, names array<string>")))
        items.unpersist()
    both = reduce(DataFrame.unionAll, tables).groupBy("row_key").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("names")).alias("names"))
    return both.select("row_key", F.arrow_udf(_joined, "struct<n_hit: bigint, n_items: bigint, items_sha256: string>")("spans", "names").alias("r")).select("row_key", "r.*")


def contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside a place of a window: ``window`` consecutive words of an item, or a whole shorter one),
    n_items (distinct ids of the items with such places), items_sha256 (of these ids, sorted as strings and joined by a comma) and contaminated.

    Null and empty texts have no words and aren't hit; an item without words has no window. The windows of an item without an id count as
    hits, but it isn't counted or listed; rows that share an item_id are one item with the windows of both. Repeated documents are rows of their own. Other columns aren't read.
    Texts of any length are searched whole. Empty tables give an empty result, or no hits."""
    n, get = _blocks(benchmark, window, block)
    if n == 1:
        return docs.select("doc_id", _column(get(0), F.col("text")).alias("r")).select("doc_id", "r.*")
    ws = Workspace(docs.sparkSession, "suffixes")
    rows = ws.keep(docs.select("doc_id", F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row_key")))
    found = _keyed(rows, benchmark, window, n, get, ws)
    count = F.arrow_udf(lambda t: _counted(t), "bigint")(F.col("text"))
    rows = rows.select("doc_id", "row_key", count.alias("n_words")).join(found, "row_key", "left")
    return ws.close(rows.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("n_items", F.lit(0)).alias("n_items"),
                                F.coalesce("items_sha256", F.lit(_digest([]))).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated")))


def _counted(text: pa.Array) -> pa.Array:
    data, off = buffers(text)
    return pa.array(np.concatenate([np.zeros(0, np.int64), *(Words(plain(data[off[lo]:off[hi]]), off[lo:hi + 1] - off[lo], 0, hi - lo).count for lo, hi in pieces(off, SHARD))]).astype(np.int64))


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, block: int = BLOCK) -> DataFrame:
    """The rows of ``docs`` without a place of a window, all their columns. Odd cases as in ``contamination``."""
    n, get = _blocks(benchmark, window, block)
    names = docs.columns
    if n == 1:
        return docs.select(F.struct("*").alias("row"), _column(get(0), F.col("text")).alias("r")).where("not r.contaminated").select(*[F.col(f"row.`{c}`") for c in names])
    ws = Workspace(docs.sparkSession, "suffixes")
    rows = ws.keep(docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("row_key")))
    return ws.close(rows.join(_keyed(rows, benchmark, window, n, get, ws), "row_key", "left_anti").select(*[F.col(f"row.`{c}`") for c in names]))


def op12_suffix_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {SQL_WORDS} AS w FROM documents),
b AS (SELECT item_id, {SQL_WORDS} AS w FROM benchmark),
win AS (SELECT item_id, least(len(w), 10) AS k, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS g
    FROM b, LATERAL (SELECT unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM win),
g AS (SELECT rid, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g FROM (SELECT rid, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
m AS (SELECT rid, k, i, g FROM g SEMI JOIN (SELECT DISTINCT k, g FROM win) USING (k, g)),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM m) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM
    (SELECT DISTINCT rid, item_id::VARCHAR AS name FROM m JOIN win USING (k, g) WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN it USING (rid)
"""
