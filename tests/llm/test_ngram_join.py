import random

import numpy as np
import pyarrow as pa

from foldwise.llm import ngram_join as N
from foldwise.llm.work import Workspace


def brute(rows, n, percent):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, set() if not w else {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}))
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a], sets[b]
            if x[0] is not None and y[0] is not None and x[1] and y[1] and 100 * len(x[1] & y[1]) >= percent * len(x[1] | y[1]):
                root[find(a)] = find(b)
    out = []
    for a, (i, s) in enumerate(sets):
        ids = [sets[b][0] for b in range(len(sets)) if find(b) == find(a) and sets[b][0] is not None]
        out.append((i, len(s), None if i is None else min(ids)))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def corpus(seed, groups):
    rnd = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    passage = [rnd.choice(vocab) for _ in range(30)]
    rows = []
    for size, edits in groups:
        base = [rnd.choice(vocab) for _ in range(rnd.randint(30, 80))]
        for _ in range(size):
            w = list(base)
            for _ in range(rnd.randint(0, edits)):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((len(rows), " ".join(w)))
    for _ in range(40):
        own = [rnd.choice(vocab) for _ in range(rnd.randint(1, 20))]
        rows.append((len(rows), " ".join(own[:5] + passage + own[5:])))
    return rows


def test_against_brute_force(spark, docs_of, monkeypatch):
    monkeypatch.setattr(N, "SHORT", 4)
    monkeypatch.setattr(N, "BLOCK", 8)
    monkeypatch.setattr(N, "COLUMN_BLOCK", 16)
    monkeypatch.setattr(N, "HEAVY_FROM", 5)
    rows = corpus(1, [(60, 3), (20, 2), (3, 1), (5, 8)])
    assert got(N.ngram_jaccard(docs_of(rows), n=4, percent=85)) == brute(rows, 4, 85)


def test_edge_cases(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "a b c d e f"), (8, "a b c d e f"), (8, "a b c d e f"),
            (None, "a b c d e f"), (None, None), (9, "é x b c d"), (10, "x" * 100_000)]
    assert got(N.ngram_jaccard(docs_of(rows, extra=("content", "token", "size", "component_id", "label")))) == brute(rows, 5, 80)


def test_repeated_ids_with_other_texts(spark, docs_of, monkeypatch):
    rnd = random.Random(12)
    rows = []
    for i in range(40):
        for side in "ab":  # the two texts of an id have nothing in common, each has near copies under other ids
            base = [f"{side}{i}w{k}" for k in range(60)]
            rows.append((i, " ".join(base)))
            for _ in range(2):
                near = list(base)
                near[rnd.randrange(60)] = "x"
                rows.append((rnd.randrange(40, 50), " ".join(near)))
    rnd.shuffle(rows)
    assert got(N.ngram_jaccard(docs_of(rows))) == brute(rows, 5, 80)
    monkeypatch.setattr(N, "SHORT", 1)  # the long lists' product
    assert got(N.ngram_jaccard(docs_of(rows))) == brute(rows, 5, 80)


def test_empty(spark, docs_of):
    assert got(N.ngram_jaccard(docs_of([]))) == []


def test_lists_that_share_rows_do_not_meet_as_one(spark):
    entries = [(t, c, 100, 0, c) for t in range(40) for c in range(20 * t, 20 * t + 30)]  # all rows hang together by their lists
    lists = spark.createDataFrame(entries, "token long, content long, size int, pos int, label long")
    ws = Workspace(spark, "dealt")
    assert N._dealt(lists, 85, ws).count() == len(entries)
    ws.drop()


def test_a_very_long_list_meets_in_pairs_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", 4)
    sizes = [50 + k for k in range(60)]
    lists = spark.createDataFrame([(1, c, s, 0, c) for c, s in enumerate(sizes)], "token long, content long, size int, pos int, label long")
    ws = Workspace(spark, "dealt")
    met = {}
    for r in N._dealt(lists, 85, ws).collect():
        met.setdefault((r.i, r.j), []).append((r.content, r.blk))
    ws.drop()
    together = {frozenset((x, y)) for (i, j), rows in met.items() for x, bx in rows for y, by in rows if x != y and {bx, by} == {i, j}}
    assert together >= {frozenset((x, y)) for x in range(60) for y in range(x) if 100 * sizes[y] >= 85 * sizes[x]}
    assert max(len(rows) for rows in met.values()) < 40


def test_parities_keep_every_pair_that_reaches_the_threshold():
    rng = np.random.default_rng(5)
    for percent in (80, 85):
        sets, links = [], []
        for k in range(60):
            base = rng.integers(0, 1 << 47, rng.integers(1, 900)).astype(np.uint64)
            near = base.copy()
            near[:rng.integers(0, len(base) // 8 + 1)] = rng.integers(0, 1 << 47, 1).astype(np.uint64)
            sets += [np.unique(base), np.unique(near)]
        size = np.array([len(s) for s in sets])
        rows = [np.frombuffer(N._parities(s, percent), "<u8") for s in sets]
        i, j, _ = N._reachable(size, np.zeros(len(sets), int), rows, np.zeros((len(sets),) * 2, bool), percent)
        found = set(zip(i.tolist(), j.tolist()))
        for a in range(len(sets)):
            for b in range(a + 1, len(sets)):
                both = len(np.intersect1d(sets[a], sets[b]))
                if both and 100 * both >= percent * (size[a] + size[b] - both):
                    links.append((a, b))
        assert found >= set(links) and len(found) < len(links) + 60


def test_a_list_may_go_on_in_the_next_batch():
    rng = np.random.default_rng(9)
    base = rng.integers(0, 1 << 47, 200).astype(np.uint64)
    rows = []
    for token, n in ((1, 5), (2, 1), (3, 4)):
        rows += [{"token": token, "i": 0, "j": 0, "blk": 0, "content": 10 * token + k, "size": 200, "pos": 0, "label": k // 2,
                  "parities": N._parities(np.sort(np.concatenate([base[k:], base[:k] ^ np.uint64(1)])), 85)} for k in range(n)]
    schema = pa.schema([(k, pa.int64()) for k in rows[0] if k != "parities"] + [("parities", pa.binary())])
    want = {(10 * t + a, 10 * t + b) for t, n in ((1, 5), (3, 4)) for a in range(n) for b in range(a + 1, n) if a // 2 != b // 2}
    for step in (1, 2, 3, 100):
        batches = [pa.RecordBatch.from_pylist(rows[k:k + step], schema) for k in range(0, len(rows), step)]
        got_ = [(r["a"], r["b"]) for b in N._meetings(iter(batches), 85, False) for r in b.to_pylist()]
        assert set(got_) == want and len(got_) == len(want)
        forest = [(r["token"], r["p"], r["q"]) for b in N._meetings(iter(batches), 85, True) for r in b.to_pylist()]
        assert len(forest) == 3 and {t for t, _, _ in forest} == {1, 3}
