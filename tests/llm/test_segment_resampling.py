import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from foldwise.llm.segment_resampling import segment_resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def features(text, max_n):
    w = words(text)
    return [" ".join(w[i:i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, max_n, buckets, percent, least):
    of = lambda text: [zlib.crc32(f.encode()) % buckets for f in features(text, max_n)]
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(of(text))
    for text in target:
        t.update(of(text))
    big_s, big_t = float(sum(s.values())), float(sum(t.values()))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for i, (doc_id, text) in enumerate(rows):
        f = of(text)
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, i])
    able = sorted((r for r in out if len(words(rows[r[5]][1])) >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5]))
    for place, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = place
    return sorted((tuple(-1 if v is None else v for v in r[:5]) for r in out))


def texts(seed, n):
    rnd = random.Random(seed)
    lines = [" ".join(rnd.choice(["the", "Of", "größe", "x1", "l'été", "z" * 300, "…"]) for _ in range(rnd.randint(0, 9))) for _ in range(40)]
    return ["\n".join(rnd.choice(lines) for _ in range(rnd.randint(0, 8))) + rnd.choice(["", "\n", "\n\n tail"]) for _ in range(n)]


def frame(spark, docs_of, rows, target):
    b = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    return docs_of(rows, extra=("b", "n", "weight", "score", "rank", "row_key", "part")), b


@pytest.mark.parametrize("max_n", [1, 3])
def test_against_brute_force(spark, docs_of, max_n):
    rows = list(enumerate(texts(max_n, 300))) + [(7, "the same the same " * 9)] * 3 + [(None, "x1 größe " * 30), (None, None), (900, ""), (901, "\n\n"), (902, "…")]
    rows.append((903, "größe the\nof x1 " * 60_000 + "y" * 70_000))
    docs, bench = frame(spark, docs_of, rows, texts(99, 20) + [None, ""])
    got = segment_resample(docs, bench, max_n=max_n, buckets=500, percent=30, min_words=6)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    got = sorted(tuple(-1 if v is None else v for v in r) for r in got.collect())
    want = brute(rows, texts(99, 20), max_n, 500, 30, 6)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert sorted(g[4] for g in got) == sorted(w[4] for w in want)
    pick = lambda x: sorted((r[4], r[0], r[3]) for r in x if r[4] > 0)
    assert pick(got) == pick(want)


def test_equal_rows_are_all_ranked(spark, docs_of):
    docs, bench = frame(spark, docs_of, [(5, "a b c d e f")] * 50 + [(None, "q r s t u v")] * 50, ["a b"])
    got = segment_resample(docs, bench, min_words=2, percent=80).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 81)) and len(got) == 100


def test_empty_tables(spark, docs_of):
    docs, bench = frame(spark, docs_of, [], [])
    assert segment_resample(docs, bench).count() == 0
    docs, bench = frame(spark, docs_of, [(1, "a b " * 20)], [])
    assert [tuple(r) for r in segment_resample(docs, bench, percent=100).collect()][0][:2] == (1, 40)
    with pytest.raises(ValueError):
        segment_resample(docs, bench, buckets=0)


def test_scores_follow_the_target(spark, docs_of):
    rnd = random.Random(3)
    like = [f"t{i}" for i in range(30)]
    rows = [(i, " ".join(rnd.choice(like if i % 10 == 0 else [f"o{j}" for j in range(300)]) for _ in range(40))) for i in range(400)]
    docs, bench = frame(spark, docs_of, rows, [" ".join(rnd.choice(like) for _ in range(500))])
    drawn = [r["doc_id"] for r in segment_resample(docs, bench).where("rank is not null").collect()]
    assert len(drawn) == 40 and np.mean([d % 10 == 0 for d in drawn]) > 0.95
