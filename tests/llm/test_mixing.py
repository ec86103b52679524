import random

from pyspark.sql import functions as F

from foldwise.llm import mixing
from foldwise.llm.mixing import mix_sources


def targets(sizes, most=3):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode("utf-32-be")) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in names if s not in full)
        share = (total - sum(most * sizes[s] for s in full)) / free if free else 0
        over = {s for s in names if s not in full and share * weight[s] > most * sizes[s]}
        if not over:
            return {s: float(most * sizes[s]) if s in full else share * weight[s] for s in names}
        full |= over


def corpus(seed, n=900):
    rnd = random.Random(seed)
    return [(i, " ".join(["w"] * rnd.choice([3, 20, 60, 200])), rnd.choice(["big"] * 12 + ["tiny"] + ["a", "é", "Z", None])) for i in range(n)]


def test_totals(spark, docs_of):
    rows = corpus(1)
    df = docs_of(rows, extra=("size", "target", "sid", "n", "blk"))
    out = mix_sources(df, block=16)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    sizes = {}
    for i, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = targets(sizes)
    for s in sizes:
        mine = [got[i] for i, t, x in rows if x == s]
        assert all(r.source_size == sizes[s] and abs(r.target - want[s]) <= 1e-9 * want[s] for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= 200  # at most one document is left open
    assert all(r.size == len(t.split()) and 0 <= r.taken <= 3 * r.size for i, t, _ in rows for r in [got[i]])
    again = {r.doc_id: r.taken for r in mix_sources(df.repartition(5), block=16).collect()}
    assert again == {i: r.taken for i, r in got.items()}


def test_expectation(spark, docs_of):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 2]) for i in range(40)]
    df = docs_of(rows).cache()
    total = [0] * 40
    runs = 6
    for seed in range(runs):
        for r in mix_sources(df, seed=seed).collect():
            total[r.doc_id] += r.copies
            ratio = r.target / r.source_size
            assert int(ratio) <= r.copies <= int(ratio) + 1
    assert abs(sum(total) / runs / 40 - 1) < 0.3


def test_edge_cases(spark, docs_of):
    assert mix_sources(docs_of([])).collect() == []
    rows = [(1, None, None), (2, "", "a"), (3, "x y", "a"), (3, "x y", "a"), (None, "z", None), (4, "q " * 20_000, "b")]
    out = mix_sources(docs_of(rows)).collect()
    assert len(out) == 6 and all(r.taken <= 3 * r.size for r in out) and sum(r.size for r in out) == 20_005
    blank = mix_sources(docs_of([(1, None, None), (2, " ", "a")])).collect()
    assert [(r.size, r.taken, r.target) for r in blank] == [(0, 0, 0.0)] * 2


def test_equal_rows_are_many_blocks(spark, docs_of, monkeypatch):
    """A third of the rows is one row without an id, a third shares an id: both go through many bounded blocks."""
    monkeypatch.setattr(mixing, "RUN", 7)
    rows = [(None, "x y z", "a")] * 300 + [(7, "w " * (1 + i % 5), "a") for i in range(300)] + [(10 + i, "v v", "b") for i in range(300)]
    df = docs_of(rows)
    out = sorted(map(tuple, mix_sources(df, block=16).collect()), key=str)
    assert len(out) == 900 and sum(r[1] for r in out) == sum(len(t.split()) for _, t, _ in rows)
    assert sorted(map(tuple, mix_sources(df.repartition(7), block=16).collect()), key=str) == out
    for size in {r[2] for r in out}:
        mine = [r for r in out if r[2] == size]
        assert abs(sum(r[4] for r in mine) - mine[0][3]) <= 5
    numbered = mixing._numbered(df.select("doc_id", F.xxhash64("text").alias("content"))).groupBy("doc_id", "content", "again").count()
    assert numbered.count() == 900 and numbered.agg(F.max("count")).first()[0] == 1
    blocks = numbered.groupBy(F.pmod(F.xxhash64("doc_id", "content", "again"), F.lit(20))).count().agg(F.max("count")).first()[0]
    assert blocks < 90  # 45 rows on average
