import hashlib
import random
import re

import numpy as np
import pytest

from foldwise.llm.suffix_decontamination import _keys, contamination, decontaminate, longest_matches, suffix_array

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(rows, items, window):
    wins = {}
    for name, text in items:
        w = words(text)
        k = min(window, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            wins.setdefault(tuple(w[i:i + k]), set()).add(name)
    out = []
    for doc_id, text in rows:
        w, hit, names = words(text), set(), set()
        for k in {len(x) for x in wins}:
            for i in range(len(w) - k + 1):
                found = wins.get(tuple(w[i:i + k]))
                if found is not None:
                    hit |= set(range(i, i + k))
                    names |= found
        names = sorted(str(n) for n in names if n is not None)
        out.append((-1 if doc_id is None else doc_id, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def corpus(seed, n=250, vocab=14):
    rnd = random.Random(seed)
    voc = ["the", "Of", "größe", "x1", "été", "42"] + [f"v{i}" for i in range(vocab)]
    items = [(i, " ".join(rnd.choice(voc) for _ in range(rnd.choice([1, 3, 6, 9, 17])))) for i in range(60)]
    items += [(3, "another text of item three"), (None, "no id here v1"), (61, None), (62, ""), (63, "…!"), (64, items[5][1]), (65, items[5][1].upper())]
    rows = []
    for i in range(n):
        t = [rnd.choice(voc + ["unknown"]) for _ in range(rnd.randint(0, 40))]
        for _ in range(rnd.randint(0, 2)):
            t[rnd.randint(0, len(t)):0] = rnd.choice(items[:60])[1].split()
        rows.append((i, ", ".join(t)))
    return rows, items


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_against_brute_force(spark, docs_of, block):
    rows, items = corpus(1)
    rows += [(None, None), (None, items[2][1]), (None, items[2][1]), (7, ""), (8, rows[8][1]), (900, "…")]
    rows.append((901, " unknown ".join(x[1] or "" for x in items[:60]) * 150 + " z" * 50_000))
    docs = docs_of(rows, extra=("row", "r", "spans", "names", "row_key", "n_hit"))
    got = contamination(docs, bench(spark, items), window=6, block=block)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in map(tuple, got.collect()))
    assert got == brute(rows, items, 6)
    clean = decontaminate(docs, bench(spark, items), window=6, block=block)
    assert clean.columns == docs.columns
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in clean.collect()) == [r[0] for r in got if not r[5]]


def test_longest_matches(spark, docs_of):
    rows, items = corpus(2, n=60, vocab=4)
    for block in (1 << 20, 200):
        got = longest_matches(docs_of(rows), bench(spark, items), block=block).collect()
        text = {i: words(t) for i, t in rows}
        seen = {}
        for r in got:
            match = text[r["doc_id"]][r["doc_word"]:r["doc_word"] + r["n_words"]]
            seen.setdefault((r["item_id"], r["item_word"]), []).append(match)
        grams = {tuple(w[i:j]) for w in text.values() for i in range(len(w)) for j in range(i + 1, min(len(w), i + 20) + 1)}
        want = {}
        for name, t in items:
            w = words(t)
            for i in range(len(w)):
                n = max((k for k in range(1, len(w) - i + 1) if tuple(w[i:i + k]) in grams), default=0)
                if n:
                    want.setdefault((None if name is None else str(name), i), []).append(w[i:i + n])
        assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}


def test_suffix_array_is_sorted():
    rnd = np.random.default_rng(5)
    for n_ids, w in ((2, 3), (40, 2)):
        seq = rnd.integers(0, n_ids + 1, 3000)
        seq[500:900] = seq[1500:1900]
        seq[-1] = 0
        bits = int(n_ids).bit_length()
        order = suffix_array(seq, _keys(seq, bits, w), bits, w, 64)
        ends = np.append(np.flatnonzero(seq == 0), len(seq))
        suffix = [tuple(seq[p:min(p + 64, ends[np.searchsorted(ends, p)])]) for p in order]
        assert suffix == sorted(suffix) and sorted(order) == list(np.flatnonzero(seq))


def test_empty_tables(spark, docs_of):
    none, some = bench(spark, []), bench(spark, [(1, "a b c")])
    assert contamination(docs_of([]), some).count() == 0 and longest_matches(docs_of([]), some).count() == 0
    r = contamination(docs_of([(1, "a b c")]), none).collect()
    assert [tuple(x)[:4] for x in r] == [(1, 3, 0, 0)] and not r[0]["contaminated"]
    assert decontaminate(docs_of([(1, "x A, b-c y"), (2, "a b")]), some).select("doc_id").collect() == [(2,)]


def test_hot_passage_and_hot_items(spark, docs_of):
    """A passage in a third of the documents that a third of the items share: one digest, worked out once."""
    passage = " ".join(f"p{i}" for i in range(14))
    rows = [(i, f"q{i} {passage} r{i}" if i % 3 == 0 else f"s{i} t") for i in range(600)]
    items = [(i, passage if i % 3 == 0 else f"u{i} v w x") for i in range(600)]
    got = {r["doc_id"]: r for r in contamination(docs_of(rows), bench(spark, items)).collect()}
    names = sorted(str(i) for i in range(0, 600, 3))
    assert {r["n_hit"] for i, r in got.items() if i % 3 == 0} == {14} and got[0]["n_items"] == 200
    assert got[3]["items_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
    assert not any(r["contaminated"] for i, r in got.items() if i % 3)
