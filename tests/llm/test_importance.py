import random

import numpy as np

from pyspark.sql import functions as F

from foldwise.llm.importance import BUCKETS, PASSAGE, importance_resample
from foldwise.llm.textkit import Words

LABELS = "doc_id long, quality int, toxic int"


def test_separates_and_counts(spark, docs_of):
    rnd = random.Random(2)
    good, bad = [f"g{k}" for k in range(50)], [f"b{k}" for k in range(50)]
    rows = [(i, " ".join(rnd.choice(good if i % 2 else bad) for _ in range(60))) for i in range(300)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)] + [(None, 1, 0), (5, None, None)], LABELS)
    out = {r.doc_id: r for r in importance_resample(docs_of(rows, extra=("key", "kept", "id", "target")), labels).collect()}
    assert len(out) == 300 and sum(r.kept for r in out.values()) == 150
    assert np.mean([r.kept == bool(i % 2) for i, r in out.items()]) > 0.95
    keys = sorted((r.key for r in out.values()), reverse=True)
    assert all(r.kept == (r.key >= keys[149]) for r in out.values())


def test_edge_cases(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (3, "a b"), (None, "c"), (4, "z " * 30_000)]
    labels = spark.createDataFrame([(3, 1, 0)], LABELS)
    out = importance_resample(docs_of(rows), labels, share=3 / 7).collect()
    assert len(out) == 7 and sum(r.kept for r in out) == 3 and not any(r.kept for r in out if r.n_grams == 0)
    none = spark.createDataFrame([], LABELS)
    assert len(importance_resample(docs_of(rows), none).collect()) == 7
    assert importance_resample(docs_of([]), none).collect() == []


def _grams(text):
    """Buckets of the words and word pairs of one text, one after the other."""
    raw = np.frombuffer(text.encode(), np.uint8)
    h = [int(x) for x in Words(raw, np.array([0, len(raw)]), 0, 1).hashes(lower=True)] if len(raw) else []
    pairs = [text.lower().split()[i:i + 2] for i in range(len(h) - 1)]
    joint = {}
    for p in {tuple(x) for x in pairs}:
        one = " ".join(p).encode()
        joint[p] = _pair_bucket(one)
    return [x >> 48 for x in h] + [joint[tuple(p)] for p in pairs]


def _pair_bucket(raw):
    from foldwise.llm.importance import _grams as library

    data = np.frombuffer(raw, np.uint8)
    return int(library(Words(data, np.array([0, len(data)]), 0, 1))[0][-1])


def test_weights_keys_and_choice_match_recount(spark, docs_of):
    rnd = random.Random(5)
    rows = [(i, " ".join(f"w{int(rnd.paretovariate(0.7)) % (40 if i % 3 else 60)}" for _ in range(rnd.randint(1, 40)))) for i in range(120)]
    target = {i for i in range(60) if i % 3}
    labels = spark.createDataFrame([(i, int(i in target), 0) for i in range(60)], LABELS)
    raw, aim = np.full(BUCKETS, 1.0), np.full(BUCKETS, 1.0)
    for i, text in rows:
        for b in _grams(text):
            raw[b] += 1
            aim[b] += i in target
    ratio = np.log(aim / aim.sum()) - np.log(raw / raw.sum())
    weight = {i: float(np.mean(ratio[_grams(text)])) for i, text in rows}
    chosen = []
    for seed in (11, 12):
        h = spark.range(120).select("id", F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 52)).alias("h")).collect()
        key = {r.id: PASSAGE * weight[r.id] - np.log(-np.log((r.h + 0.5) / 2.0 ** 52)) for r in h}
        out = {r.doc_id: r for r in importance_resample(docs_of(rows), labels, share=0.5, seed=seed).collect()}
        assert all(abs(out[i].log_weight - weight[i]) < 1e-9 and abs(out[i].key - key[i]) < 1e-6 for i in weight)
        chosen.append({i for i, r in out.items() if r.kept})
        assert chosen[-1] == set(sorted(key, key=lambda i: -key[i])[:60])
    assert chosen[0] != chosen[1]


def test_draw_is_in_proportion_to_weights(spark, docs_of):
    """Two texts whose log weights differ by d: the better one is drawn first in 1 / (1 + exp(-d)) of the seeds."""
    rows = [(i, "a b " * 10 + ("b a" if i % 2 else "a a")) for i in range(400)] + [(500 + i, "a b " * 12) for i in range(40)]
    labels = spark.createDataFrame([(500 + i, 1, 0) for i in range(40)], LABELS)
    out = [r for r in importance_resample(docs_of(rows), labels, share=0.5).collect() if r.doc_id < 500]
    w = [np.mean([r.log_weight for r in out if r.doc_id % 2 == k]) for k in (0, 1)]
    key = {r.doc_id: r.key for r in out}
    odds = np.mean([key[i + 1] > key[i] for i in range(0, 400, 2)])
    assert abs(odds - 1 / (1 + np.exp(-PASSAGE * (w[1] - w[0])))) < 0.1
