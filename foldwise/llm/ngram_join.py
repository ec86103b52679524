"""N-gram Jaccard join: a blocked sparse product of the document by n-gram
incidence matrix with itself.

Rows of the matrix are *contents*: texts with the same shingle set are one row,
so copies cost one row of the matrix and are joined back by their content id.
Columns are shingles in one fixed order, rare ones first and *heavy* ones
(those met repeatedly inside single tasks) last. With threshold t = percent/100
a row x only needs its first ``|x| - ceil(t|x|) + 1`` columns: two rows that
reach t share one of them (the size-derived bound that drops all later
columns from the candidate product).

1. *Column statistics*: one pass yields (doc_id, set size, content id, parities of its columns in buckets) and the
   heavy columns; at most ``MAX_HEAVY`` of them are broadcast, a fixed bound.
2. *Candidate product*: (column, content, size, position) entries are shuffled
   by column, so each task holds a block of columns and accumulates the pairs
   of their short lists. A pair whose sizes differ too much is dropped at once, and one
   whose count and remaining columns cannot reach the bound after the last block.
3. *Long lists* (more than ``SHORT`` rows) are not expanded into pairs: every
   row meets one leader of its size class in each list, and accepted pairs form components.
4. *Full product*: pairs whose parities differ in no more bits than their sets may in columns accumulate their overlap over all columns;
   ``100 * overlap >= percent * union`` decides.
5. Rows of a long list that are still in different components meet there (in a very long one in salted pairs of row blocks of
   neighbouring size classes), first as parities. Only rows that can reach the threshold with a row of another component are
   sent to one list of the pair as whole sets and multiplied; it returns links, at most one for each of its rows.
   This is done for the likeliest pair of every two components first, then for all pairs of what is still apart.

A text with fewer words than the n-gram has its whole word sequence as its only
shingle; a null text or one without words has none and links with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.components import components
from foldwise.llm.textkit import Words, buffers, mix, pieces, release, windows
from foldwise.llm.work import Workspace

#: at most so many heavy columns are broadcast (8 bytes each)
MAX_HEAVY = 1 << 20
#: a column is heavy from this count on
HEAVY_FROM = 12
#: lists up to this length are expanded directly
SHORT = 24
#: row and column blocks of the full product
BLOCK, COLUMN_BLOCK = 256, 4096
#: rows about candidates (32 bytes each) that are broadcast; more are joined by a shuffle
MAX_BROADCAST = 500_000
#: columns counted together, and contents remembered, by one task
HELD, SEEN = 2_000_000, 150_000
#: bytes of a column number sent to the full product, whole
SENT = 6
#: blocks of rows of a long list that meet in one piece, and most bits of a row's parities
LIST, MAX_BITS = 4, 1 << 16

_U = np.uint64
_TOKEN_BITS = 47
_TOKEN_MASK = _U((1 << _TOKEN_BITS) - 1)


class Shingled:
    """Shingle sets of the texts of one piece, as sorted 48-bit columns: bit 47
    marks a heavy column, so ascending order is the column order."""

    def __init__(self, w: Words, n: int, heavy: "Heavy | None" = None):
        h = w.hashes(lower=True)
        g, at = windows(h, w.first, n)
        doc = w.doc[at]
        short = []
        for k in range(1, n):
            d = np.flatnonzero(w.count == k)
            if len(d):
                s, p = windows_of(h, w.first[d], k)
                short.append((s, d))
        if short:
            g = np.concatenate([g, *[s for s, _ in short]])
            doc = np.concatenate([doc, *[d for _, d in short]])
        token = g >> _U(64 - _TOKEN_BITS)
        if heavy is not None:
            token = token | (heavy.has(token).astype(_U) << _U(_TOKEN_BITS))
        key = (doc.astype(_U) << _U(48)) | token
        key.sort()
        if len(key):
            key = key[np.concatenate([[True], key[1:] != key[:-1]])]
        self.doc = (key >> _U(48)).astype(np.int64)
        self.token = key & _U((1 << 48) - 1)
        self.first = np.searchsorted(self.doc, np.arange(w.n_docs + 1))
        self.size = np.diff(self.first)
        plain = mix((self.token & _TOKEN_MASK) + _U(0x5851F42D4C957F2D))
        total = np.zeros(len(plain) + 1, _U)
        np.cumsum(plain, out=total[1:])
        self.content = mix(total[self.first[1:]] - total[self.first[:-1]] + self.size.astype(_U)).view(np.int64)


def windows_of(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each ``first`` on (texts of exactly k words)."""
    idx = first[:, None] + np.arange(k)[None, :]
    flat = h[idx].reshape(-1)
    return windows(flat, np.arange(0, len(flat) + 1, k), k)


class Heavy:
    """Membership test for the heavy columns (a bitmap before the search)."""

    BITS = 24

    def __init__(self, tokens: np.ndarray):
        self.tokens = np.sort(tokens.astype(_U))
        self.map = np.zeros(1 << self.BITS, bool)
        self.map[(self.tokens & _U((1 << self.BITS) - 1)).astype(np.int64)] = True

    def has(self, token: np.ndarray) -> np.ndarray:
        out = self.map[(token & _U((1 << self.BITS) - 1)).astype(np.int64)]
        at = np.flatnonzero(out)
        if len(at):
            j = np.searchsorted(self.tokens, token[at])
            out[at] = self.tokens[np.minimum(j, len(self.tokens) - 1)] == token[at]
        return out


def _pieces(batch: pa.RecordBatch, col: int) -> Iterator[tuple[int, int, Words]]:
    data, off = buffers(batch.column(col))
    for lo, hi in pieces(off):
        if hi - lo > 1 << 15:  # 16 bits hold the text's number inside a piece
            mid = range(lo, hi, 1 << 15)
            for a in mid:
                yield a, min(hi, a + (1 << 15)), Words(data, off, a, min(hi, a + (1 << 15)))
        else:
            yield lo, hi, Words(data, off, lo, hi)


def _statistics(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """kind 0: (doc_id, size, content, parities); kind 1: (token, count, null, null) for tokens
    met at least twice within a task."""

    def run(batches):
        held: list[np.ndarray] = []
        held_rows = 0

        def repeats():
            t = np.sort(np.concatenate(held))
            edge = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            c = np.diff(np.append(edge, len(t)))
            ok = c > 1
            return pa.RecordBatch.from_arrays(
                [pa.array(np.ones(ok.sum(), np.int32)), pa.array(t[edge][ok].astype(np.int64)), pa.array(c[ok].astype(np.int64)),
                 pa.nulls(int(ok.sum()), pa.int64()), pa.nulls(int(ok.sum()), pa.binary())], names=["kind", "a", "b", "c", "p"])

        seen: set[int] = set()
        for batch in batches:
            for lo, hi, w in _pieces(batch, 1):
                s = Shingled(w, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(hi - lo, np.int32)), batch.column(0).slice(lo, hi - lo), pa.array(s.size.astype(np.int64)),
                     pa.array(s.content), pa.array([_parities(s.token[x:y], percent) for x, y in zip(s.first[:-1], s.first[1:])], pa.binary())], names=["kind", "a", "b", "c", "p"])
                new = np.array([c not in seen and not seen.add(c) for c in s.content.tolist()], bool)
                if len(seen) > SEEN:
                    seen.clear()
                held.append(s.token[new[s.doc]])
                held_rows += len(held[-1])
                if held_rows > HELD:  # bounded memory: counts are summed over tasks anyway
                    yield repeats()
                    held.clear()
                    held_rows = 0
        if held_rows:
            yield repeats()
        held.clear()
        seen.clear()
        release()

    return docs.mapInArrow(run, "kind int, a long, b long, c long, p binary")


def _heavy(rows: DataFrame) -> np.ndarray:
    """Tokens counted ``HEAVY_FROM`` times or more; the bar rises by steps
    until at most ``MAX_HEAVY`` remain, so what is broadcast stays bounded."""
    counts = rows.where("kind = 1").groupBy("a").agg(F.sum("b").alias("n")).where(F.col("n") >= HEAVY_FROM)
    hist = counts.groupBy(F.floor(F.log2("n") * 4).cast("int").alias("step")).count().collect()
    left, bar = 0, -1
    for step, c in sorted(((r["step"], r["count"]) for r in hist), reverse=True):
        if left + c > MAX_HEAVY:
            bar = step
            break
        left += c
    kept = counts.where(F.floor(F.log2("n") * 4).cast("int") > F.lit(bar)).select("a").toPandas()["a"]
    return kept.to_numpy(np.int64)


def _entries(docs: DataFrame, n: int, percent: int, heavy) -> DataFrame:
    """(token, content, size, position) of the columns a row needs."""

    def run(batches):
        lookup = Heavy(heavy.value) if len(heavy.value) else None
        seen: set[int] = set()
        for batch in batches:
            for _, _, w in _pieces(batch, 0):
                s = Shingled(w, n, lookup)
                fresh = np.array([c not in seen and not seen.add(c) for c in s.content.tolist()], bool)
                if len(seen) > SEEN:
                    seen.clear()
                need = s.size - (percent * s.size + 99) // 100 + 1
                pos = np.arange(len(s.token)) - s.first[s.doc]
                ok = fresh[s.doc] & (pos < need[s.doc])
                d = s.doc[ok]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(s.token[ok].view(np.int64)), pa.array(s.content[d]), pa.array(s.size[d].astype(np.int32)),
                     pa.array(pos[ok].astype(np.int32))], names=["token", "content", "size", "pos"])
        seen.clear()
        release()

    return docs.select("text").mapInArrow(run, "token long, content long, size int, pos int")


def _accumulated(found: DataFrame, lists: DataFrame | None, percent: int) -> DataFrame:
    """Pairs (a, b) that can still reach the threshold after the candidate product.
    Up to the earlier end of the two needed parts every shared column was met:
    counted here or, in a long list, at most as often as either row stands in
    long lists. What follows adds at most the rest of the row whose part ended."""
    pairs = found.where("kind = 0").groupBy("a", "b").agg(F.count("*").alias("n"), F.first("size").alias("sa"), F.first("pos").alias("sb"))
    pairs = pairs.withColumn("long", F.lit(0))
    if lists is not None:
        often = lists.groupBy("content").agg(F.count("*").alias("m"))
        for side in ("a", "b"):
            pairs = pairs.join(often.select(F.col("content").alias(side), F.col("m").alias(f"m{side}")), side, "left")
        pairs = pairs.withColumn("long", F.least(F.coalesce("ma", F.lit(0)), F.coalesce("mb", F.lit(0))))
    rest = f"greatest(({percent} * sa + 99) div 100, ({percent} * sb + 99) div 100) - 1"
    need = f"({percent} * (sa + sb) + {99 + percent}) div {100 + percent}"
    return pairs.where(f"n + long + {rest} >= {need}").select("a", "b")


def _pair_batch(kind, a, b, s, p):
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b), pa.array(s), pa.array(p)],
        names=["kind", "a", "b", "size", "pos"])


def _short_lists(batches, percent: int):
    """Entries sorted by (token, content) -> kind 0: a shared column of the pair
    (a < b) with the sizes of both; kind 1: entries of long lists as (token, content, size, pos)."""
    tail = [np.zeros(0, np.int64)] * 4
    long_token = None  # the list that runs on from earlier batches and is known to be long

    def expand(cols, final):
        nonlocal tail, long_token
        tok, con, siz, pos = cols
        if len(tok):  # the same content from two tasks
            keep = np.concatenate([[True], (tok[1:] != tok[:-1]) | (con[1:] != con[:-1])])
            tok, con, siz, pos = (x[keep] for x in (tok, con, siz, pos))
        if not len(tok):
            return
        edge = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]]))
        run = np.diff(np.append(edge, len(tok)))
        length = np.repeat(run, run)
        is_long = length > SHORT
        if long_token is not None:
            is_long |= tok == long_token
        open_ = np.zeros(len(tok), bool)
        if not final:
            last = tok == tok[-1]
            if is_long[-1]:
                long_token = tok[-1]  # pass on what is there, remember the list
                tail = [x[-1:] for x in (tok, con, siz, pos)]
                open_[-1] = True
            else:
                long_token = None if long_token != tok[-1] else long_token
                tail = [x[last] for x in (tok, con, siz, pos)]
                open_ = last
        else:
            tail = [x[:0] for x in (tok, con, siz, pos)]
        go = is_long & ~open_
        if go.any():
            yield _pair_batch(1, tok[go], con[go], siz[go].astype(np.int64), pos[go].astype(np.int64))
        few = ~is_long & ~open_ & (length > 1)
        t, c, s = (x[few] for x in (tok, con, siz))
        k = 1
        live = np.arange(len(t))
        while len(live):
            live = live[live + k < len(t)]
            live = live[t[live] == t[live + k]]
            if not len(live):
                break
            i, j = live, live + k
            ok = 100 * np.minimum(s[i], s[j]) >= percent * np.maximum(s[i], s[j])
            i, j = i[ok], j[ok]
            if len(i):
                yield _pair_batch(0, c[i], c[j], s[i], s[j])
            k += 1

    for batch in batches:
        cols = [np.concatenate([t, batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)]) for k, t in enumerate(tail)]
        yield from expand(cols, False)
    yield from expand(tail, True)
    release()


def _linked(pairs: DataFrame, docs: DataFrame, reps: DataFrame, n: int, percent: int, ws: Workspace) -> DataFrame:
    """The pairs (a, b) of contents that reach the threshold: overlap over
    all columns, from one whole text of each content concerned. The set of a is sent
    once to each of its salted groups, where it meets at most about ``BLOCK`` sets."""
    pairs = ws.keep(pairs.select("a", "b").distinct())
    pairs = ws.keep(_likely(pairs, reps, percent))
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("m"))
    pairs = pairs.join(groups, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("m")).cast("int"))
    sides = pairs.select(F.col("b").alias("content"), "a", "salt", "b").unionAll(
        groups.select(F.col("a").alias("content"), "a", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("salt"), F.lit(None).cast("long").alias("b")))
    need = ws.keep(sides.join(reps, "content").select(F.col("low").alias("doc_id"), "content", "a", "salt", "b"))
    few = need.count() <= MAX_BROADCAST
    rows = _sets(docs, need, n, few).select("a", "salt", "b", "tokens")

    def overlap(batches):
        held, own = None, None
        for batch in batches:
            a, salt, b, tokens = (batch.column(k) for k in range(4))
            is_a = np.asarray(b.is_null())
            key, other = a.to_numpy(zero_copy_only=False), b.fill_null(0).to_numpy(zero_copy_only=False)
            raw, off = buffers(tokens)
            ok = np.zeros(len(key), bool)
            for i in range(len(key)):
                t = _unpacked(raw[off[i]:off[i + 1]])
                if is_a[i]:
                    held, own = key[i], t
                elif held == key[i]:
                    z = np.concatenate([own, t])
                    z.sort()
                    both = int((z[1:] == z[:-1]).sum())
                    ok[i] = 100 * both >= percent * (len(own) + len(t) - both)
            yield pa.RecordBatch.from_arrays([pa.array(key[ok]), pa.array(other[ok])], names=["a", "b"])
        release()

    parts = int(ws.spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return ws.keep(rows.mapInArrow(overlap, "a long, b long").distinct())


def _sets(docs: DataFrame, need: DataFrame, n: int, few: bool) -> DataFrame:
    """``need`` with the packed shingle set of each row's content, from the texts
    of its doc_id (rows that share it may have other contents)."""
    ids = need.select("doc_id").distinct()

    def sets(batches):
        for batch in batches:
            for lo, hi, w in _pieces(batch, 1):
                s = Shingled(w, n)
                raw = np.ascontiguousarray(s.token.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SENT]).tobytes()
                first = (s.first * SENT).tolist()
                made = [raw[x:y] for x, y in zip(first[:-1], first[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(s.content), pa.array(made, pa.binary())],
                    names=["doc_id", "content", "tokens"])
        release()

    texts = docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi").select("doc_id", "text")
    return texts.mapInArrow(sets, "doc_id long, content long, tokens binary").join(F.broadcast(need) if few else need, ["doc_id", "content"])


def _unpacked(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // SENT, 8), np.uint8)
    out[:, :SENT] = raw.reshape(-1, SENT)
    return out.reshape(-1).view("<u8")


def _size_class(percent: int):
    return F.floor(F.log(F.col("size").cast("double")) / F.log(F.lit(100.0 / percent))).cast("int")


def _stars(lists: DataFrame, percent: int) -> DataFrame:
    """Each row of a long list with the leader (another one in each list) of its size class and of the
    class below."""
    rows = lists.withColumn("class", _size_class(percent))
    rank = F.struct(F.xxhash64("content", "token"), "content", "size", "pos")
    lead = rows.groupBy("token", "class").agg(F.min(rank).alias("lead"))
    met = rows.withColumn("class", F.explode(F.array("class", F.col("class") - 1))).join(lead, ["token", "class"])
    met = met.where("lead.content <> content")
    return _bounded(met.select(F.col("content").alias("x"), F.col("lead.content").alias("y"), F.col("size").alias("sx"),
                               F.col("lead.size").alias("sy"), F.col("pos").alias("px"), F.col("lead.pos").alias("py")), percent)


def _bounded(met: DataFrame, percent: int) -> DataFrame:
    need = f"ceil({percent} * (sx + sy) / {100 + percent})"
    ok = f"100 * least(sx, sy) >= {percent} * greatest(sx, sy) and least(sx - px, sy - py) >= {need}"
    return met.where(ok).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _product(x: list[np.ndarray], y: list[np.ndarray], skip: np.ndarray, percent: int) -> np.ndarray:
    """Which rows of two blocks reach the threshold: overlap counts accumulate over
    blocks of columns, and rows none of whose pairs can still reach their bound are dropped."""
    sx, sy = np.array([len(t) for t in x]), np.array([len(t) for t in y])
    need = -(-percent * (sx[:, None] + sy[None, :]) // (100 + percent))
    col, at = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    row = np.repeat(np.arange(len(x) + len(y)), np.concatenate([sx, sy]))
    left = row < len(x)
    common = np.zeros(len(col), bool)
    in_x, in_y = np.zeros(len(col), bool), np.zeros(len(col), bool)
    in_x[at[left]], in_y[at[~left]] = True, True
    common = in_x & in_y
    rest_x, rest_y = (np.bincount(row[common[at]], minlength=len(x) + len(y))[k] for k in (slice(0, len(x)), slice(len(x), None)))
    number = np.cumsum(common) - 1
    keep = common[at]
    row, at = row[keep], number[at[keep]]
    count = np.zeros((len(x), len(y)), np.float32)
    alive = ~skip & (np.minimum(rest_x[:, None], rest_y[None, :]) >= need)
    for c0 in range(0, int(common.sum()), COLUMN_BLOCK):
        ux, uy = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        if not len(ux):
            break
        here = (at >= c0) & (at < c0 + COLUMN_BLOCK)
        r, c = row[here], at[here] - c0
        m = np.zeros((len(x) + len(y), COLUMN_BLOCK), np.float32)
        m[r, c] = 1
        got = m.sum(1)
        count[np.ix_(ux, uy)] += m[ux] @ m[len(x) + uy].T
        rest_x, rest_y = rest_x - got[:len(x)], rest_y - got[len(x):]
        alive &= count + np.minimum(rest_x[:, None], rest_y[None, :]) >= need
    return alive & (100 * count >= percent * (sx[:, None] + sy[None, :] - count))


def _parities(tokens: np.ndarray, percent: int) -> bytes:
    """Parities of the numbers of columns in 2**k buckets. Two sets differ in as many columns at least as their parities in bits;
    sets without likeness differ in about half of the bits, which with enough of them is more than a linked pair may."""
    apart = 2 * len(tokens) * (100 - percent) / (100 + percent)  # most columns in which a linked pair of this size differs
    bits = 64
    while bits < MAX_BITS and bits / 2 - 3 * bits**0.5 <= apart:
        bits *= 2
    count = np.bincount((mix(tokens + _U(0x2545F4914F6CDD1D)) & _U(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((count & 1).astype(np.uint8), bitorder="little").tobytes()


def _folded(parities: np.ndarray, words: int) -> np.ndarray:
    """Parities (64 bits a word) in fewer buckets."""
    return np.bitwise_xor.reduce(parities.reshape(-1, words), 0)


def _differing(parities: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """In how many parities the rows of each pair differ."""
    words = np.array([len(p) for p in parities], np.int64)
    both = np.minimum(words[i], words[j])
    out = np.zeros(len(i), np.int64)
    for w in np.unique(both):
        at = np.flatnonzero(both == w)
        rows, own = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
        bits = np.stack([_folded(parities[r], w) for r in rows.tolist()])
        x, y = own[:len(at)], own[len(at):]
        for lo in range(0, len(at), 1 << 14):
            k = slice(lo, lo + (1 << 14))
            out[at[k]] = np.bitwise_count(bits[x[k]] ^ bits[y[k]]).sum(1, dtype=np.int64)
    return out


def _likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose parities leave the threshold open, so that whole sets of others needn't be sent."""
    few = pairs.count() <= MAX_BROADCAST
    for side in ("a", "b"):
        own = reps.select(F.col("content").alias(side), F.col("size").alias(f"s{side}"), F.col("parities").alias(f"p{side}"))
        pairs = own.join(F.broadcast(pairs) if few else pairs, side)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            sa, sb = (batch.column(k).to_numpy() for k in (2, 3))
            rows = [np.frombuffer(v.as_buffer(), "<u8") for k in (4, 5) for v in batch.column(k)]
            at = np.arange(n)
            ok = _differing(rows, at, at + n) <= sa + sb + 2 * (-percent * (sa + sb) // (100 + percent))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(ok)) for k in (0, 1)], names=["a", "b"])
        release()

    return pairs.select("a", "b", "sa", "sb", "pa", "pb").mapInArrow(run, "a long, b long")


def _reachable(size: np.ndarray, pos: np.ndarray, parities: list[np.ndarray], skip: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs (i < j) of rows whose first shared column may stand at ``pos`` and that can reach the threshold, and how many more
    parities might differ."""
    big, small = np.maximum(size[:, None], size[None, :]), np.minimum(size[:, None], size[None, :])
    need = -(-percent * (big + small) // (100 + percent))
    most = np.minimum((size - pos)[:, None], (size - pos)[None, :])
    i, j = np.nonzero(np.triu(~skip & (100 * small >= percent * big) & (most >= need), 1))
    spare = size[i] + size[j] - 2 * need[i, j] - _differing(parities, i, j)
    ok = spare >= 0
    return i[ok], j[ok], spare[ok]


def _forest(p: np.ndarray, q: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """Of pairs between components p and q a forest of those with most to spare."""
    nodes, ends = np.unique(np.concatenate([p, q]), return_inverse=True)
    u, v = ends[:len(p)], ends[len(p):]
    code = np.minimum(u, v) * len(nodes) + np.maximum(u, v)
    order = np.lexsort((-spare, code))
    order = order[np.concatenate([[True], code[order][1:] != code[order][:-1]])]  # the best of each two components
    low, left, out = np.arange(len(nodes)), len(nodes) - 1, []
    for k in order[np.argsort(-spare[order], kind="stable")].tolist():
        x, y = low[u[k]], low[v[k]]
        if x != y:
            low[low == max(x, y)] = min(x, y)
            out.append(k)
            left -= 1
            if not left:
                break
    return np.array(out, np.int64)


def _meetings(batches, percent: int, likeliest: bool):
    """Rows sorted by (token, i, j) -> pairs of rows of different components (p, q) that a list's block pair leaves, or a forest of the likeliest."""
    held: list[pa.RecordBatch] = []

    def pairs(t):
        token, i, j, blk, content, size, pos, label = (t[k].to_numpy() for k in ("token", "i", "j", "blk", "content", "size", "pos", "label"))
        raw = t["parities"].combine_chunks()
        edge = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]), [True]]))
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist()):
            g = slice(lo, hi)
            skip = label[g][:, None] == label[g][None, :]
            if i[lo] != j[lo]:  # each block is a pair with itself elsewhere
                skip |= blk[g][:, None] == blk[g][None, :]
            if skip.all():
                continue
            x, y, spare = _reachable(size[g].astype(np.int64), pos[g].astype(np.int64), [np.frombuffer(raw[k].as_buffer(), "<u8") for k in range(lo, hi)], skip, percent)
            if len(x) and likeliest:
                at = _forest(label[g][x], label[g][y], spare)
                x, y, spare = x[at], y[at], spare[at]
            if len(x):
                u, v, p, q = content[g][x], content[g][y], label[g][x], label[g][y]
                cols = [np.minimum(u, v), np.maximum(u, v), np.minimum(p, q), np.maximum(p, q), -spare, *(np.full(len(x), c[lo]) for c in (token, i, j))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["a", "b", "p", "q", "over", "token", "i", "j"])

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([*held, batch]).combine_chunks()
        last = np.ones(t.num_rows, bool)
        for k in ("token", "i", "j"):
            c = t[k].to_numpy()
            last &= c == c[-1]
        done = int(last.argmax())  # the last group may go on in the next batch
        if done:
            yield from pairs(t.slice(0, done))
        held = t.slice(done).to_batches()
    if held:
        yield from pairs(pa.Table.from_batches(held))
    release()


def _dealt(lists: DataFrame, percent: int, ws: Workspace) -> DataFrame:
    """Entries of lists with their block ``blk`` and each pair of blocks (i, j) that they meet in: one for a list of up to ``LIST`` blocks."""
    # a step of a class is a little more than the ratio of two linked sizes, so these never lie further apart than one class
    step = float(np.log(100.0 / percent) * (1 + 1e-6))
    cols = [*lists.columns, "blk"]
    lists = lists.withColumn("class", F.floor(F.log(F.col("size").cast("double")) / step).cast("long"))
    large = lists.groupBy("token").count().where(F.col("count") > LIST * BLOCK).select("token")
    blocks = ws.keep(lists.join(large, "token", "left_semi").groupBy("token", "class").agg(F.ceil(F.count("*") / BLOCK).alias("nb")))
    number = lambda c, k: F.shiftleft(c, 32) + k  # noqa: E731  a block's number
    lists = lists.join(F.broadcast(blocks), ["token", "class"], "left").withColumn(
        "blk", F.coalesce(number(F.col("class"), F.pmod(F.xxhash64("content"), F.col("nb"))), F.lit(0).cast("long")))
    partners = blocks.select("token", F.col("class").alias("near"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("nb") - 1)).alias("k"))
    met = lists.where("nb is not null").withColumn("near", F.explode(F.array(F.col("class") - 1, "class", F.col("class") + 1))).join(
        F.broadcast(partners), ["token", "near"]).withColumn("other", number(F.col("near"), F.col("k")))
    return met.select(*cols, F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j")).unionAll(
        lists.where("nb is null").select(*cols, F.col("blk").alias("i"), F.col("blk").alias("j")))


def _across(lists: DataFrame, docs: DataFrame, n: int, percent: int, likeliest: bool, ws: Workspace) -> DataFrame:
    """Links between rows of long lists that are in different components so far. The rows of a list meet each other, those of
    a list of more than ``LIST`` blocks in salted pairs of row blocks of one size class or two that touch, each of which
    returns at most one link for each of its rows. What grows is the number of entries in lists, not the square of the rows that lists connect.
    ``likeliest``: only the likeliest pair of two components, of a forest in each list; so few are left when all pairs are met."""
    rows = ws.keep(lists.groupBy("content").agg(F.first("label").alias("label"), F.first("low").alias("doc_id")))
    parts = int(ws.spark.conf.get("spark.sql.shuffle.partitions"))
    met = _dealt(lists.drop("low"), percent, ws).repartition(parts, "token", "i", "j").sortWithinPartitions("token", "i", "j")
    pairs = ws.keep(met.mapInArrow(lambda it: _meetings(it, percent, likeliest), "a long, b long, p long, q long, over long, token long, i long, j long"))
    # a pair that several lists leave is multiplied in one of them
    once = pairs.groupBy("p", "q").agg(F.min(F.struct("over", "a", "b", "token", "i", "j")).alias("at")).select("at.*") if likeliest else (
        pairs.groupBy("a", "b").agg(F.min(F.struct("token", "i", "j")).alias("at")).select("a", "b", "at.*"))
    need = once.select(F.explode(F.array("a", "b")).alias("content"), "token", "i", "j").distinct().join(rows, "content")
    need = ws.keep(need)
    few = need.count() <= MAX_BROADCAST
    sets = _sets(docs, need, n, few).select("token", "i", "j", "content", "label", "tokens")

    def product(table: pa.Table) -> pa.Table:
        content, label = (table[k].to_numpy() for k in ("content", "label"))
        raw, off = buffers(table["tokens"])
        _, pick = np.unique(content, return_index=True)  # rows that share a doc_id bring the same content twice
        tokens = [_unpacked(raw[off[k]:off[k + 1]]) for k in pick.tolist()]
        skip = (label[pick][:, None] == label[pick][None, :]) | (np.arange(len(pick))[:, None] >= np.arange(len(pick))[None, :])
        u, v = np.nonzero(_product(tokens, tokens, skip, percent))
        root: dict[int, int] = {}

        def find(k):
            while root.get(k, k) != k:
                k = root[k]
            return k

        out = []
        for a, b in zip(pick[u].tolist(), pick[v].tolist()):
            p, q = find(int(label[a])), find(int(label[b]))
            if p != q:
                root[p] = q
                out.append((a, b))
        return pa.table({"a": pa.array(content[[a for a, _ in out]], pa.int64()), "b": pa.array(content[[b for _, b in out]], pa.int64())})

    return ws.keep(sets.groupBy("token", "i", "j").applyInArrow(product, "a long, b long"))


def ngram_jaccard(docs: DataFrame, *, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_shingles`` (size of its set) and
    ``component_id``, the smallest doc_id reachable by links
    ``100 * |A & B| >= percent * |A | B|`` over ``n``-word shingles (A-Z lower-cased).

    Uses the columns ``doc_id`` and ``text`` alone, whatever else the table
    holds. A null or wordless text has no shingle, size 0 and its own id as
    component; repeated rows each get their row; a row without a doc_id keeps its
    size, has no component and links with nothing; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "ngram-join")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    stats = ws.keep(_statistics(docs, n, percent))
    row = stats.where("kind = 0").select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"), F.col("c").alias("content"))
    heavy = spark.sparkContext.broadcast(_heavy(stats))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = ws.keep(
        _entries(docs, n, percent, heavy).repartition(parts, "token").sortWithinPartitions("token", "content")
        .mapInArrow(lambda it: _short_lists(it, percent), "kind int, a long, b long, size long, pos long"))
    lists = found.where("kind = 1").select(F.col("a").alias("token"), F.col("b").alias("content"), "size", "pos").distinct()
    n_long = lists.count()
    if n_long:
        lists = ws.keep(lists)
    pairs = _accumulated(found, lists if n_long else None, percent)
    if n_long:
        pairs = pairs.unionAll(_stars(lists, percent))
    reps = ws.keep(stats.where("kind = 0 and b > 0 and a is not null").groupBy(F.col("c").alias("content")).agg(
        F.min("a").alias("low"), F.first("b").alias("size"), F.first("p").alias("parities")))
    edges = _linked(pairs, docs, reps, n, percent, ws)
    label = ws.keep(components(edges, ws))
    if n_long:
        for likeliest in (True, False):
            now = lists.join(label.withColumnRenamed("node", "content"), "content", "left")
            now = ws.keep(now.withColumn("label", F.coalesce("component", "content")).drop("component"))
            live = now.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("token")
            lists = now.join(live, "token", "left_semi")
            if likeliest:  # components only grow: what is live later is live now
                lists = ws.keep(lists.join(reps.select("content", "low", "parities"), "content"))
            more = _across(lists, docs, n, percent, likeliest, ws)
            lists = lists.drop("label")
            # components of the components found so far
            ends = more.join(label.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(
                label.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
            merged = components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")), ws).select(
                F.col("node").alias("component"), F.col("component").alias("merged"))
            known = label.unionAll(merged.select(F.col("component").alias("node"), "component").join(label.select("node"), "node", "left_anti"))
            label = ws.keep(known.join(merged, "component", "left").select("node", F.coalesce("merged", "component").alias("component")))
    classes = reps.join(label.withColumnRenamed("node", "content"), "content", "left").withColumn("component", F.coalesce("component", "content"))
    least = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    classes = classes.join(least, "component").select("content", "component_id")
    out = row.join(classes, "content", "left").select(
        "doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return ws.close(out)


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return ngram_jaccard(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=4, percent=85)


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n u ON u.doc_id = a JOIN n v ON v.doc_id = b WHERE 100 * c >= 85 * (u.n + v.n - c)),
r(doc_id, t) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.t = e.a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.t) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY d.doc_id
"""
