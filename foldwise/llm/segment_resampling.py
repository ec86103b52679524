"""Target-distribution importance resampling with segment deduplication.

Hashed n-gram counts of all raw and of all target texts give every bucket a gain, the
scaled logarithm of its ratio of smoothed shares. A document's weight is the sum
of the gains of its n-grams; Gumbel noise from a hash of its id is added, and the
highest scores are drawn.

Texts are cut into lines. A task takes whole texts up to a bounded number of bytes
(one longer text alone), and of each distinct line among them counts the n-grams inside it once;
a line's counts, or its summed gain, are multiplied by its occurrences. N-grams that cross a line
break are added separately, from the first and last words of each line. Lines are
compared by their bytes, not by a hash. Copies that land in different tasks are counted in each:
the tasks send one sum a bucket, which is less than any exchange of lines.

Buckets are CRC-32 values of the UTF-8 bytes of the words joined by a space, computed for all words
at once, byte position by byte position.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.plainwords import SQL_WORDS, plain
from foldwise.llm.textkit import Words, buffers, pieces, release
from foldwise.llm.work import Workspace

PIECE = 2 << 20
#: most buckets: two doubles of each pass the driver
MAX_BUCKETS = 1 << 22
#: words of more bytes are hashed one by one
LONG_WORD = 256

_T = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _T = np.where(_T & 1, (_T >> 1) ^ np.uint32(0xEDB88320), _T >> 1)


def _advance(state: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC states after the bytes ``start .. start + size``, from the states before."""
    order = np.argsort(-np.minimum(size, LONG_WORD + 1).astype(np.int16), kind="stable")
    at, n, s = start[order], size[order], state[order]
    n_long = int(np.searchsorted(-n, -LONG_WORD))  # sizes above LONG_WORD come first, in any order among themselves
    for i in range(n_long):
        s[i] = zlib.crc32(data[at[i]:at[i] + n[i]].tobytes(), int(s[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    at, n, rest = at[n_long:], n[n_long:], s[n_long:]
    up_to = len(n) - np.searchsorted(n[::-1], np.arange(1, LONG_WORD + 1))  # number of words of at least 1, 2, ... bytes
    for j, m in enumerate(up_to):
        if not m:
            break
        x = rest[:m]
        rest[:m] = _T[(x ^ data[at[:m] + j]) & np.uint32(255)] ^ (x >> np.uint32(8))
    out = np.empty_like(s)
    out[order] = s
    return out


def _space(state: np.ndarray) -> np.ndarray:
    return _T[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8))


class Segments:
    """The lines of the texts ``lo..hi`` of a batch and the features in and across them."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lo: int, hi: int, max_n: int, buckets: int):
        self.n_docs, self.max_n, self.buckets = hi - lo, max_n, buckets
        raw, o = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        breaks = raw == 10
        before = np.concatenate([[0], np.cumsum(breaks)])
        # a line begins at each text and behind each break; the breaks themselves are taken out
        begin = np.sort(np.concatenate([o[:-1], np.flatnonzero(breaks) + 1]), kind="stable")
        self.doc = np.repeat(np.arange(self.n_docs), np.diff(before[o]) + 1)
        edge = np.append(begin - before[begin], len(raw) - before[-1]).astype(np.int64)
        text = np.ascontiguousarray(raw[~breaks])
        lines = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(edge), pa.py_buffer(text)])
        coded = lines.dictionary_encode()
        self.line = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        distinct, cut = buffers(coded.dictionary)
        self.w = Words(plain(distinct), cut, 0, len(cut) - 1)
        self.size = self.w.end - self.w.start
        self.n_lines = len(cut) - 1

    def _bucket(self, state: np.ndarray) -> np.ndarray:
        return ((state ^ np.uint32(0xFFFFFFFF)) % np.uint32(self.buckets)).astype(np.int64)

    def inside(self):
        """(bucket, distinct line) of the n-grams inside distinct lines, length by length."""
        w = self.w
        state = np.full(len(w.start), 0xFFFFFFFF, np.uint32)
        at = np.arange(len(w.start))
        for n in range(1, self.max_n + 1):
            if n > 1:
                stay = (at + n - 1 < len(w.doc)) & (w.doc[np.minimum(at + n - 1, len(w.doc) - 1)] == w.doc[at]) if len(at) else np.zeros(0, bool)
                at, state = at[stay], _space(state[stay])
            if not len(at):
                return
            last = at + n - 1
            state = _advance(state, w.data, w.start[last], self.size[last])
            yield self._bucket(state), w.doc[at]

    def across(self):
        """(bucket, text) of the n-grams that cross a line break, length by length."""
        k, w = self.max_n - 1, self.w
        if not k or not len(w.start):
            return
        count = w.count[self.line]
        ends = np.minimum(count, 2 * k)  # the first k and last k words of a line, or all
        seg = np.repeat(np.arange(len(self.line)), ends)
        nth = np.arange(len(seg)) - np.repeat(np.cumsum(ends) - ends, ends)
        skipped = (count[seg] > 2 * k) & (nth >= k)
        word = w.first[self.line[seg]] + nth + np.where(skipped, count[seg] - 2 * k, 0)
        hole = np.cumsum(skipped & (nth == k))  # grows where words were left out
        doc = self.doc[seg]
        at = np.arange(len(seg))
        state = _advance(np.full(len(seg), 0xFFFFFFFF, np.uint32), w.data, w.start[word], self.size[word])
        for n in range(2, self.max_n + 1):
            last = at + n - 1
            ok = last < len(seg)
            at, last, state = at[ok], last[ok], state[ok]
            ok = (doc[at] == doc[last]) & (hole[at] == hole[last])
            at, last, state = at[ok], last[ok], state[ok]
            state = _advance(_space(state), w.data, w.start[word[last]], self.size[word[last]])
            cross = seg[at] != seg[last]
            yield self._bucket(state[cross]), doc[at[cross]]

    def counts(self) -> np.ndarray:
        """Features in each bucket."""
        times = np.bincount(self.line, minlength=self.n_lines)
        out = np.zeros(self.buckets, np.int64)
        for bucket, line in self.inside():
            out += np.bincount(bucket, weights=times[line], minlength=self.buckets).astype(np.int64)
        for bucket, _ in self.across():
            out += np.bincount(bucket, minlength=self.buckets)
        return out

    def weigh(self, gain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, features, summed gain) of each text. Sums of integers below 2**53 are exact in doubles."""
        n, total = np.zeros(self.n_lines), np.zeros(self.n_lines)
        for bucket, line in self.inside():
            n += np.bincount(line, minlength=self.n_lines)
            total += np.bincount(line, weights=gain[bucket], minlength=self.n_lines)
        of = lambda x: np.bincount(self.doc, weights=x[self.line], minlength=self.n_docs)
        words, n, total = of(self.w.count), of(n), of(total)
        for bucket, doc in self.across():
            n += np.bincount(doc, minlength=self.n_docs)
            total += np.bincount(doc, weights=gain[bucket], minlength=self.n_docs)
        return tuple(np.rint(x).astype(np.int64) for x in (words, n, total))


def bucket_counts(texts: DataFrame, column: str, max_n: int, buckets: int) -> DataFrame:
    """(b, n): number of features in each bucket that holds any, over all rows."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            data, off = buffers(batch.column(0))
            for lo, hi in pieces(off, PIECE):
                total += Segments(data, off, lo, hi, max_n, buckets).counts()
        at = np.flatnonzero(total)
        release()
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["b", "n"])

    return texts.select(F.col(column).cast("string")).mapInArrow(run, "b int, n long").groupBy("b").agg(F.sum("n").alias("n"))


def bucket_gains(raw: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """floor(scale * ln(share in the target / share in the raw text)) of each bucket, add-one smoothed."""
    k, s_all, t_all = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(scale * math.log((float(t) + 1) * (s_all + k) / ((float(s) + 1) * (t_all + k)))) for s, t in zip(raw, target, strict=True)], np.float64)


def _ranked(rows: DataFrame, ws: Workspace) -> DataFrame:
    """``rows`` with ``place`` (1, 2, ...) by score, ties to the smaller doc_id (null last), then
    by row. A range sort numbers rows inside its partitions; the partitions' sizes give offsets."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), "row_key"]
    cut = ws.keep(rows.orderBy(*order).withColumn("nth", F.monotonically_increasing_id()))
    part = F.shiftright("nth", 33)
    sizes = sorted(cut.groupBy(part.cast("int").alias("part")).count().collect())  # one row a partition
    start, at = [], 0
    for p, n in sizes:
        start.append((p, at))
        at += n
    offsets = rows.sparkSession.createDataFrame(start, "part int, before long")
    inner = F.col("nth") - F.shiftleft(part, 33)
    return cut.withColumn("part", part.cast("int")).join(F.broadcast(offsets), "part").withColumn("place", F.col("before") + inner + 1)


def segment_resample(docs: DataFrame, target: DataFrame, *, max_n: int = 1, buckets: int = 10_000, percent: int = 10, min_words: int = 20, seed: str = "2024") -> DataFrame:
    """One row per input row: doc_id, n_features, weight, score, rank (all long). Of the rows with at least
    ``min_words`` words ``percent`` percent (rounded down) are drawn by score; rank is null for all others.

    Null and empty texts have no words, no features and weight 0. A null doc_id is hashed as an empty text and
    comes last among equal scores. Rows that share a doc_id have the same noise and are drawn as rows of their own;
    equal rows are ordered by their place in the table as written. Texts of any length are read whole, a long one as one piece.
    Empty tables give counts of 0 and an empty result, or gains of smoothed shares alone. Other columns of
    ``docs`` and ``target`` aren't read, whatever their names. Words: ``plainwords``."""
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must be 1 to {MAX_BUCKETS}")
    spark = docs.sparkSession
    ws = Workspace(spark, "segments")
    counts = []
    for table in (docs, target):
        count = np.zeros(buckets, np.int64)
        found = bucket_counts(table, "text", max_n, buckets).toPandas()  # at most ``buckets`` rows
        count[found["b"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
        counts.append(count)
    gain = spark.sparkContext.broadcast(bucket_gains(*counts))

    def weigh(text: pa.Array) -> pa.Array:
        data, off = buffers(text)
        parts = [(np.zeros(0, np.int64),) * 3] + [Segments(data, off, lo, hi, max_n, buckets).weigh(gain.value) for lo, hi in pieces(off, PIECE)]
        return pa.StructArray.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=["n_words", "n_features", "weight"])

    u = (F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.arrow_udf(weigh, "struct<n_words: bigint, n_features: bigint, weight: bigint>")(F.col("text").cast("string")).alias("r"))
    rows = rows.select("doc_id", "r.*", (F.col("r.weight") + F.floor(-1000 * F.log(-F.log(u)))).cast("long").alias("score"), F.monotonically_increasing_id().alias("row_key"))
    rows = ws.keep(rows)
    able = F.col("n_words") >= min_words
    k = percent * rows.where(able).count() // 100
    drawn = _ranked(rows.where(able), ws).withColumn("rank", F.when(F.col("place") <= k, F.col("place")))
    cols = ["doc_id", "n_features", "weight", "score"]
    return ws.close(drawn.select(*cols, "rank").unionAll(rows.where(~able).select(*cols, F.lit(None).cast("long").alias("rank"))))


def op13_segment_resampling(spark, sf_dir: str) -> DataFrame:
    return segment_resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = f"""
WITH tab AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) r(i)),
d AS (SELECT doc_id, row_number() OVER () AS rid, {SQL_WORDS} AS w FROM documents),
dw AS (SELECT rid, unnest(w) AS word FROM d),
bw AS (SELECT unnest({SQL_WORDS}) AS word FROM benchmark),
v AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw)),
crc AS (SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
    lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8)), 4294967295) % 10000 AS b FROM v, tab),
s AS (SELECT b, count(*) AS n FROM dw JOIN crc USING (word) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM bw JOIN crc USING (word) GROUP BY b),
g AS (SELECT b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE
    / ((s.n + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (b)),
k AS (SELECT rid, count(*) AS n, sum(gain)::BIGINT AS weight FROM dw JOIN crc USING (word) JOIN g USING (b) GROUP BY rid),
x AS (SELECT doc_id, rid, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h FROM d LEFT JOIN k USING (rid)),
y AS (SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::BIGINT AS score, n_features >= 20 AS able FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id NULLS LAST, rid) AS place FROM y)
SELECT doc_id, n_features, weight, score,
    CASE WHEN able AND place <= 10 * (SELECT count(*) FROM y WHERE able) // 100 THEN place END AS rank FROM z
"""
