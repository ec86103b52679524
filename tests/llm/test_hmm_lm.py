import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from foldwise.llm import hmm_lm as H


def small_model(k, seed):
    rng = np.random.default_rng(seed)
    emit = rng.random((H.CLASSES, k))
    move = rng.random((k, k))
    start = rng.random(k)
    return H.Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def paths(seq, m):
    k = len(m.start)
    for p in itertools.product(range(k), repeat=len(seq)):
        w = m.start[p[0]] * m.emit[seq[0], p[0]]
        for t in range(1, len(seq)):
            w *= m.move[p[t - 1], p[t]] * m.emit[seq[t], p[t]]
        yield p, w


def test_forward_and_expected_counts():
    m = small_model(3, 1)
    rng = np.random.default_rng(2)
    lengths = np.array([6, 5, 5, 2, 1])
    seqs = [rng.integers(0, 4, n) for n in lengths]
    cls, start = np.concatenate(seqs), np.concatenate([[0], np.cumsum(lengths)[:-1]])
    want = [math.log(sum(w for _, w in paths(s, m))) for s in seqs]
    assert np.allclose(H.forward(cls, start, lengths, m), want)
    first, move, emit = np.zeros(3), np.zeros((3, 3)), np.zeros((H.CLASSES, 3))
    for s in seqs:
        total = sum(w for _, w in paths(s, m))
        for p, w in paths(s, m):
            first[p[0]] += w / total
            for t in range(len(s)):
                emit[s[t], p[t]] += w / total
                if t:
                    move[p[t - 1], p[t]] += w / total
    for held in (1000, 10, 5):  # also when forward variables are kept for a few steps only
        e = H.Expected(3)
        e.add(cls, start, lengths, m, held)
        assert np.allclose(e.start, first) and np.allclose(e.move, move) and np.allclose(e.emit, emit)
        assert math.isclose(e.log, sum(want))


def corpus():
    rnd = random.Random(6)
    a, b = [f"A{k}" for k in range(40)], [f"b{k}é" for k in range(40)]
    rows = [(i, " ".join(rnd.choice(a if i % 2 else b) for _ in range(rnd.randint(1, 60)))) for i in range(300)]
    return rows + [(1000, None), (1001, ""), (1002, "never seen words"), (None, "a1 a2"), (7, rows[7][1]), (7, rows[7][1]), (1003, "a1 " * 30_000)]


@pytest.mark.parametrize("counted", [1 << 18, 20])
def test_scores(spark, docs_of, monkeypatch, counted):
    monkeypatch.setattr(H, "MAX_COUNTED", counted)  # 20: most words get their count by the join
    rows = corpus()
    df = docs_of(rows, extra=("train", "uid", "score", "classes"))
    out = H.hmm_scores(df, states=2, rounds=3).collect()
    assert len(out) == len(rows)
    words = lambda t: [*(t or "").encode().lower().split(), None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    c = Counter(w for i, t in rows if not held(i) for w in words(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), held(i), len(words(t)), sum(c[w] > 0 for w in words(t)), n, round(sum(math.log10((c[w] + .1) / (n + .1 * (v + 1))) for w in words(t)), 5))
                  for i, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out) == want
    mine = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert sum(r.score for r in mine) > sum(r.base_score for r in mine) + 0.1 * sum(r.n_tokens for r in mine)


def test_likelihood_rises(spark, docs_of):
    from pyspark.sql import functions as F

    df = docs_of(corpus()).withColumn("train", F.lit(True)).withColumn("uid", F.monotonically_increasing_id())
    counts = H._counts(df)
    table = H._table(counts, df.count())
    rows = H._encoded(df, spark.sparkContext.broadcast(table)).cache()
    _, logs = H.train(rows, table, states=3, rounds=5)
    assert all(b >= a - 1e-6 * abs(a) for a, b in zip(logs, logs[1:]))


def test_model_sums_to_one():
    """The probabilities of all words, known and unseen, sum to one in every state."""
    t = H.Table(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.full(H.SHARED, H.SMOOTH), 0, 0, 0)
    m = H.Model.initial(H._class_counts(t), 3, 1)
    assert np.allclose(m.emit.sum(0), 1) and np.allclose(m.move.sum(1), 1) and math.isclose(m.start.sum(), 1)


def test_empty(spark, docs_of):
    assert H.hmm_scores(docs_of([])).collect() == []
    one = H.hmm_scores(docs_of([(0, "a b")]), states=2).collect()
    assert len(one) == 1 and one[0].n_tokens == 3 and one[0].score < 0
