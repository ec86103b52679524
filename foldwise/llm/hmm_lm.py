"""Hidden Markov language model of the corpus.

Tokens are the words of a text (A-Z lower-cased) and one end. Hidden states emit
word *classes*: each of the most frequent words is a class of its own, all
others share a class by their last three bytes, and inside such a class a word
has its smoothed relative frequency, so the model is a distribution over all words.

1. Word counts of all training texts: partial sums inside tasks, then one
   ``groupBy``; the table is as large as the vocabulary and stays in Spark.
2. Every text becomes a row of 16-bit classes, once. Words beyond the broadcast
   table (``MAX_COUNTED`` words, a fixed bound) keep their hash and get their
   count by a join.
3. First guess of the states: a mixture of unigram models, fitted by EM over all whole training
   texts inside tasks, its expected counts summed by Spark.
4. Baum-Welch: each round runs the scaled forward and backward recursions over
   all whole training texts inside tasks; the expected counts (classes x states) are
   summed by Spark, and only the new parameters, whose size is fixed, pass the driver.
5. Scores: the scaled forward recursion over every whole text; the product of its
   scale factors is the exact likelihood.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldwise.llm.textkit import Words, buffers, mix, pieces
from foldwise.llm.work import Workspace

#: words whose counts are broadcast (16 bytes each)
MAX_COUNTED = 1 << 18
#: words that are classes of their own, classes of the others
MAX_CLASSES, SHARED = 28_671, 4096
END = MAX_CLASSES + SHARED
CLASSES = END + 1
SMOOTH = 0.1
#: first probability to stay in a state: near 1, so that whole texts tell the states apart in the first rounds
STAY = 0.99
#: most rounds of the first guess of the states, its prior tokens, and the relative gain below which it has converged
MIXTURE_ROUNDS, MIXTURE_PRIOR, MIXTURE_GAIN = 25, 100.0, 1e-4
#: tokens whose forward variables a task holds at once
HELD = 400_000


def _shared_class(w: Words) -> np.ndarray:
    """Class of each word by its last three bytes (ASCII lower-cased)."""
    code = np.zeros(len(w.start), np.uint64)
    for k in range(1, 4):
        at = w.end - k
        ok = at >= w.start
        b = w.data[np.maximum(at, 0)].astype(np.uint64)
        b += np.uint64(32) * ((b >= 65) & (b <= 90))
        code = code * np.uint64(257) + np.where(ok, b + np.uint64(1), np.uint64(0))
    return (mix(code) % np.uint64(SHARED)).astype(np.int64)


def _counts(docs: DataFrame) -> DataFrame:
    """(h, b, n): word hash, shared class, training count so far."""

    def packed(held):
        h = np.concatenate([x[0] for x in held])
        b = np.concatenate([x[1] for x in held])
        n = np.concatenate([x[2] for x in held])
        order = np.argsort(h, kind="stable")
        h, b, n = h[order], b[order], n[order]
        edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return h[edge], b[edge], np.add.reduceat(n, edge)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            data, off = buffers(batch.column(0))
            for lo, hi in pieces(off):
                w = Words(data, off, lo, hi)
                if not len(w.start):
                    continue
                h = w.hashes(lower=True)
                u, at, n = np.unique(h, return_index=True, return_counts=True)
                held.append((u, _shared_class(w)[at], n))
                size += len(u)
                if size > 1_500_000:
                    held = [packed(held)]
                    size = len(held[0][0])
                    if size > 1_000_000:
                        yield rows(held[0])
                        held, size = [], 0
        if held:
            yield rows(packed(held))

    def rows(x):
        return pa.RecordBatch.from_arrays([pa.array(x[0].view(np.int64)), pa.array(x[1].astype(np.int32)), pa.array(x[2].astype(np.int64))], names=["h", "b", "n"])

    return docs.where("train").select("text").mapInArrow(run, "h long, b int, n long").groupBy("h", "b").agg(F.sum("n").alias("n"))


def _most(counts: DataFrame, bound: int) -> int:
    """Least count such that at most ``bound`` words reach it (on a grid of
    eighth powers of two, so that the histogram has a fixed size)."""
    step = F.floor(F.log2("n") * 8).cast("int")
    hist = {r["step"]: r["count"] for r in counts.groupBy(step.alias("step")).count().collect()}
    total = 0
    for s in sorted(hist, reverse=True):
        total += hist[s]
        if total > bound:
            return s + 1
    return 0


class Table:
    """Broadcast word table and class statistics."""

    def __init__(self, hashes, classes, counts, shared_mass, n_tokens, n_types, n_ends):
        self.hashes, self.classes, self.counts = hashes, classes, counts
        self.shared_mass = shared_mass  # sum of (count + SMOOTH) over the words of a shared class, and SMOOTH for unseen ones
        self.n_tokens, self.n_types, self.n_ends = n_tokens, n_types, n_ends

    def encode(self, w: Words):
        """(class, log10(count + SMOOTH), log10 of the share in the class or of its
        denominator, known, not in the table, hash) of each word."""
        h = w.hashes(lower=True)
        u, inv = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hashes, u), max(len(self.hashes) - 1, 0))
        hit = (self.hashes[at] == u) if len(self.hashes) else np.zeros(len(u), bool)
        n = np.where(hit, self.counts[at] if len(self.hashes) else 0, 0)
        cls = np.where(hit, self.classes[at] if len(self.hashes) else -1, -1)[inv]
        hit = hit[inv]
        log_n = np.where(hit, np.log10(n + SMOOTH)[inv], 0.0)
        shared = cls < 0
        b = _shared_class(w)
        share = np.where(shared, log_n - np.log10(self.shared_mass)[b], 0.0)
        return np.where(shared, MAX_CLASSES + b, cls), log_n, share, hit & (n[inv] > 0), ~hit, h


def _table(counts: DataFrame, n_ends: int) -> Table:
    n_words, n_types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    step = F.floor(F.log2("n") * 8).cast("int")
    bar, own = _most(counts, MAX_COUNTED), _most(counts, MAX_CLASSES)
    top = counts.where(step >= bar).select("h", "n", (step >= own).alias("own")).toPandas()
    top = top.assign(h=top["h"].to_numpy(np.int64).view(np.uint64)).sort_values("h")
    cls = np.full(len(top), -1, np.int64)
    mine = top["own"].to_numpy(bool)
    cls[mine] = np.arange(mine.sum())
    mass = np.full(SHARED, SMOOTH)
    for r in counts.where(step < own).groupBy("b").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        mass[r["b"]] += r["n"] + SMOOTH * r["v"]
    return Table(top["h"].to_numpy(np.uint64), cls, top["n"].to_numpy(np.int64), mass, n_words + n_ends, n_types + (n_ends > 0), n_ends)


def _encoded(docs: DataFrame, table) -> DataFrame:
    """One row per text: uid, doc_id, train, n_tokens, base and share (sums of
    logarithms of the words in the table), n_known, classes (uint16), rest (hashes of the others)."""

    def run(batches):
        t = table.value
        for batch in batches:
            data, off = buffers(batch.column(3))
            for lo, hi in pieces(off):
                w = Words(data, off, lo, hi)
                cls, log_n, share, known, rest, h = t.encode(w)
                sums = [np.concatenate([[0], np.cumsum(x)]) for x in (log_n, share, known.astype(np.int64), rest.astype(np.int64))]
                base, part, seen, n_rest = (c[w.first[1:]] - c[w.first[:-1]] for c in sums)
                at = w.first + np.arange(hi - lo + 1)  # one end after each text
                flat = np.empty(len(cls) + hi - lo, np.uint16)
                flat[at[1:] - 1] = END
                flat[np.arange(len(cls)) + w.doc] = cls
                raw, others = flat.tobytes(), h[rest].tobytes()
                edge = np.concatenate([[0], np.cumsum(n_rest)]).tolist()
                a = at.tolist()
                n_end = t.n_ends > 0
                yield pa.RecordBatch.from_arrays(
                    [batch.column(k).slice(lo, hi - lo) for k in range(3)] + [
                        pa.array(w.count + 1, pa.int64()), pa.array(base + np.log10(t.n_ends + SMOOTH)), pa.array(part), pa.array(seen + int(n_end), pa.int64()),
                        pa.array([raw[2 * a[i]:2 * a[i + 1]] for i in range(hi - lo)], pa.binary()),
                        pa.array([others[8 * edge[i]:8 * edge[i + 1]] for i in range(hi - lo)], pa.binary())],
                    names=["uid", "doc_id", "train", "n_tokens", "base", "share", "n_known", "classes", "rest"])

    return docs.select("uid", "doc_id", "train", "text").mapInArrow(
        run, "uid long, doc_id long, train boolean, n_tokens long, base double, share double, n_known long, classes binary, rest binary")


def _rest(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(uid, base, n_known) of the words outside the broadcast table."""

    def run(batches):
        for batch in batches:
            h, off = buffers(batch.column(1))
            uid = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), np.diff(off) // 8)
            yield pa.RecordBatch.from_arrays([pa.array(uid), pa.array(np.frombuffer(h.tobytes(), np.int64))], names=["uid", "h"])

    words = rows.where("octet_length(rest) > 0").select("uid", "rest").mapInArrow(run, "uid long, h long")
    met = words.join(counts.select("h", "n"), "h", "left")
    return met.groupBy("uid").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTH))).alias("more"), F.sum((F.col("n") > 0).cast("long")).alias("more_known"))


class Model:
    """Parameters: start (K), move (K x K), emit (CLASSES x K)."""

    def __init__(self, start, move, emit):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def initial(cls, class_counts: np.ndarray, states: int, seed: int, rows: DataFrame | None = None) -> "Model":
        """Sticky states whose emissions are those of a mixture of unigram
        models of all training texts of ``rows``."""
        rng = np.random.default_rng(seed)
        p = (class_counts + SMOOTH) / (class_counts + SMOOTH).sum()
        emit = p[:, None] * np.exp(rng.normal(0, 1, (len(p), states)))
        emit /= emit.sum(0)
        share = np.full(states, 1 / states)
        before = None
        for _ in range(MIXTURE_ROUNDS if rows is not None else 0):
            sent = rows.sparkSession.sparkContext.broadcast((np.log(emit), np.log(share)))
            texts, counts, log = _mixed(rows, sent, states)
            sent.unpersist()
            emit = counts + MIXTURE_PRIOR * p[:, None]
            emit /= emit.sum(0)
            share = (texts + 1) / (texts.sum() + states)
            if before is not None and log - before < MIXTURE_GAIN * abs(before):
                break
            before = log
        move = np.full((states, states), (1 - STAY) / states) + STAY * np.eye(states)
        return cls(share, move, emit)

    @classmethod
    def maximised(cls, start, move, emit, prior) -> "Model":
        start, move = start + SMOOTH, move + SMOOTH
        emit = emit + prior[:, None]
        return cls(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def _groups(lengths: np.ndarray, held: int):
    """Texts by falling length, in groups of at most ``held`` tokens (or one text)."""
    order = np.argsort(-lengths, kind="stable")
    lo, total = 0, 0
    for i, n in enumerate(lengths[order].tolist()):
        if i > lo and total + n > held:
            yield order[lo:i]
            lo, total = i, 0
        total += n
    if lo < len(order):
        yield order[lo:]


def _active(lengths: np.ndarray, steps: int) -> np.ndarray:
    """How many of the texts (falling length) are longer than t, for each t."""
    return np.searchsorted(-lengths, -np.arange(steps), "left")


def forward(cls: np.ndarray, start: np.ndarray, lengths: np.ndarray, m: Model) -> np.ndarray:
    """Natural logarithm of the likelihood of each sequence (falling lengths)."""
    out = np.zeros(len(start))
    if not len(start):
        return out
    a = None
    for t, n in enumerate(_active(lengths, int(lengths[0]))):
        b = m.emit[cls[start[:n] + t]]
        a = m.start * b if a is None else (a[:n] @ m.move) * b
        s = a.sum(1)
        a /= s[:, None]
        out[:n] += np.log(s)
    return out


class Expected:
    """Expected counts of the training texts of a task."""

    def __init__(self, states: int):
        self.start, self.move, self.emit = np.zeros(states), np.zeros((states, states)), np.zeros((CLASSES, states))
        self.log, self.tokens = 0.0, 0

    def add(self, cls, start, lengths, m: Model, held: int = HELD) -> None:
        """Forward and backward over sequences of falling lengths. Forward variables
        are kept for ``held`` tokens at a time; a longer run is cut into stretches
        of steps whose first variables are kept, and each is run again on the way back."""
        steps, k = int(lengths[0]), len(m.start)
        active = _active(lengths, steps)
        stride = max(1, held // len(start))
        firsts: list[np.ndarray | None] = [None]  # variables just before each stretch

        def run(t0, t1, a, alphas, scales):
            for t in range(t0, t1):
                n = active[t]
                b = m.emit[cls[start[:n] + t]]
                a = m.start * b if t == 0 else (a[:n] @ m.move) * b
                s = a.sum(1)
                a = a / s[:, None]
                if alphas is not None:
                    alphas.append(a)
                    scales.append(s)
                else:
                    self.log += float(np.log(s).sum())
            return a

        cuts = list(range(0, steps, stride)) + [steps]
        a = None
        for t0, t1 in zip(cuts[:-1], cuts[1:]):
            if t1 < steps:
                a = run(t0, t1, a, None, None)
                firsts.append(a)
        beta = np.ones((0, k))
        after = None  # emission, scale and beta of the step behind the stretch
        for i in range(len(cuts) - 2, -1, -1):
            t0, t1 = cuts[i], cuts[i + 1]
            alphas, scales = [], []
            run(t0, t1, firsts[i], alphas, scales)
            if i == len(cuts) - 2:
                self.log += float(sum(np.log(s).sum() for s in scales))
            seen, gammas = [], []
            for t in range(t1 - 1, t0 - 1, -1):
                n, alpha = active[t], alphas[t - t0]
                beta = np.ones((n, k))
                if after is not None:
                    nn = len(after)
                    self.move += m.move * (alpha[:nn].T @ after)
                    beta[:nn] = after @ m.move.T
                c = cls[start[:n] + t]
                gammas.append(alpha * beta)
                seen.append(c)
                after = m.emit[c] * beta / scales[t - t0][:, None]
                if t == 0:
                    self.start += gammas[-1].sum(0)
            c, g = np.concatenate(seen), np.ascontiguousarray(np.concatenate(gammas).T)
            for j in range(k):
                self.emit[:, j] += np.bincount(c, weights=g[j], minlength=CLASSES)
        self.tokens += int(lengths.sum())


def _sequences(col: pa.Array):
    raw, off = buffers(col)
    cls = np.frombuffer(raw.tobytes(), np.uint16).astype(np.int64)
    return cls, off[:-1] // 2, np.diff(off) // 2


def _expect(rows: DataFrame, model, states: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, float, int]:
    """Expected counts of all training texts, summed by Spark."""
    names = [f"v{j}" for j in range(states)]

    def run(batches):
        m, e = model.value, Expected(states)
        for batch in batches:
            cls, start, lengths = _sequences(batch.column(0))
            for g in _groups(lengths, HELD):
                e.add(cls, start[g], lengths[g], m)
        at = np.flatnonzero(e.emit.sum(1) > 0)
        body = np.vstack([e.emit[at], e.move, e.start[None, :], np.concatenate([[e.log, e.tokens], np.zeros(states)])[None, :states]])
        idx = np.concatenate([at, CLASSES + np.arange(states + 2)]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(idx), *(pa.array(body[:, j]) for j in range(states))], names=["idx", *names])

    sums = rows.where("train").select("classes").mapInArrow(run, ", ".join(["idx int", *(f"{n} double" for n in names)]))
    got = sums.groupBy("idx").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    table = np.zeros((CLASSES + states + 2, states))
    table[got["idx"].to_numpy(np.int64)] = got[names].to_numpy(np.float64)
    return table[CLASSES + states], table[CLASSES:CLASSES + states], table[:CLASSES], float(table[-1, 0]), int(table[-1, 1])


def _class_counts(t: Table) -> np.ndarray:
    out = np.zeros(CLASSES)
    own = t.classes >= 0
    out[t.classes[own]] = t.counts[own]
    out[MAX_CLASSES:END] = t.shared_mass
    out[END] = t.n_ends
    return out


def _mixed(rows: DataFrame, model, states: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Expected texts of each state, expected tokens of each class and state, and the log likelihood of
    the mixture over all training texts, summed by Spark."""
    names = [f"v{j}" for j in range(states)]

    def run(batches):
        log_emit, log_share = model.value
        texts, counts, total = np.zeros(states), np.zeros((CLASSES, states)), 0.0
        for batch in batches:
            cls, start, lengths = _sequences(batch.column(0))
            if not len(start):
                continue
            log = np.stack([np.add.reduceat(log_emit[:, j][cls], start) for j in range(states)], 1) + log_share
            top = log.max(1, keepdims=True)
            r = np.exp(log - top)
            mass = r.sum(1, keepdims=True)
            total += float((top + np.log(mass)).sum())
            r /= mass
            texts += r.sum(0)
            for j in range(states):
                counts[:, j] += np.bincount(cls, weights=np.repeat(r[:, j], lengths), minlength=CLASSES)
        at = np.flatnonzero(counts.sum(1) > 0)
        body = np.vstack([counts[at], texts[None, :], np.concatenate([[total], np.zeros(states - 1)])[None, :]])
        idx = np.concatenate([at, [CLASSES, CLASSES + 1]]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(idx), *(pa.array(body[:, j]) for j in range(states))], names=["idx", *names])

    sums = rows.where("train").select("classes").mapInArrow(run, ", ".join(["idx int", *(f"{n} double" for n in names)]))
    got = sums.groupBy("idx").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    table = np.zeros((CLASSES + 2, states))
    table[got["idx"].to_numpy(np.int64)] = got[names].to_numpy(np.float64)
    return table[CLASSES], table[:CLASSES], float(table[-1, 0])


def train(rows: DataFrame, table: Table, *, states: int = 8, rounds: int = 3, seed: int = 7) -> tuple[Model, list[float]]:
    """Baum-Welch on the training rows; also the log likelihood before each round."""
    counts = _class_counts(table)
    prior = (counts + SMOOTH) / (counts + SMOOTH).sum()
    model, logs = Model.initial(counts, states, seed, rows if table.n_ends else None), []
    for _ in range(rounds if table.n_tokens else 0):
        sent = rows.sparkSession.sparkContext.broadcast(model)
        start, move, emit, log, _ = _expect(rows, sent, states)
        logs.append(log)
        model = Model.maximised(start, move, emit, prior)
        sent.unpersist()
    return model, logs


def hmm_scores(docs: DataFrame, *, states: int = 8, rounds: int = 3, seed: int = 7) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (smoothed unigram) and score (hidden Markov model), both log10.

    Learns from the rows whose ``crc32(doc_id as text) mod 10`` isn't 0; a null
    doc_id counts as the empty text and is held out. A null or empty text is its
    end alone. Repeated rows count as often as they stand; other columns aren't
    used. An empty table gives an empty result; without training rows all words are unknown.
    """
    spark = docs.sparkSession
    ws = Workspace(spark, "hmm")
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(10)) == 0
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("train", ~held)
    counts = ws.keep(_counts(docs))
    n_ends = docs.where("train").count()
    table = _table(counts, n_ends)
    sent = spark.sparkContext.broadcast(table)
    rows = ws.keep(_encoded(docs.withColumn("uid", F.monotonically_increasing_id()), sent))
    model, _ = train(rows, table, states=states, rounds=rounds, seed=seed)
    final = spark.sparkContext.broadcast(model)

    def score(col: pa.Array) -> pa.Array:
        cls, start, lengths = _sequences(col)
        out = np.zeros(len(lengths))
        for g in _groups(lengths, HELD):
            out[g] = forward(cls, start[g], lengths[g], final.value)
        return pa.array(out / np.log(10))

    rest = _rest(rows, counts)
    total = float(np.log10(table.n_tokens + SMOOTH * (table.n_types + 1)))
    more, known = F.coalesce("more", F.lit(0.0)), F.coalesce("more_known", F.lit(0))
    out = rows.select("uid", "doc_id", "train", "n_tokens", "base", "share", "n_known", F.arrow_udf(score, "double")(F.col("classes")).alias("hmm"))
    out = out.join(rest, "uid", "left").select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", (F.col("n_known") + known).alias("n_known"), F.lit(table.n_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(total)).alias("base_score"), (F.col("hmm") + F.col("share") + more).alias("score"))
    return ws.close(out)


def op10_hmm_language_model(spark, sf_dir: str) -> DataFrame:
    return hmm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
