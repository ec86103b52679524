import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline as P
from tests.llm.test_ngram_join import brute as near_brute
from tests.llm.test_quality_rules import brute as quality_brute
from tests.llm.test_secret_grammar import brute as secret_brute


def corpus():
    rnd = random.Random(12)
    vocab = [f"word{k}" for k in range(3000)]
    rows = []
    for i in range(60):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(60, 120))]
        if i % 3 == 0:
            w.insert(7, 'token = "' + "".join(rnd.choice("0123456789abcdef") for _ in range(40)) + '"')
        rows.append((len(rows), " ".join(w), rnd.choice(["a", "b", None])))
        for _ in range(rnd.choice([0, 0, 2, 5])):  # near and exact copies
            c = list(w)
            if rnd.random() < 0.6:
                c[rnd.randrange(len(c))] = "other"
            rows.append((len(rows), " ".join(c), "a"))
    rows += [(len(rows), None, "a"), (len(rows) + 1, "", "b"), (len(rows) + 2, "too short", "a"), (len(rows) + 3, "same line again\n" * 40, "b")]
    return rows


@pytest.fixture(scope="module")
def stages(spark, docs_of):
    docs, out = docs_of(corpus()), []
    for _, f in P.STAGES:
        docs = f(spark, docs, "").cache()
        out.append(docs)
    return out


def test_quality_stage(stages):
    want = {i for i, t, _ in corpus() if quality_brute(t)[6]}
    assert {r.doc_id for r in stages[0].collect()} == want and stages[0].columns == P.COLUMNS


def test_near_duplicate_stage(stages):
    rows = [(r.doc_id, r.text) for r in stages[0].collect()]
    want = {i for i, _, c in near_brute(rows, 5, 80) if i == c}
    got = [r.doc_id for r in stages[1].collect()]
    assert sorted(got) == sorted(want) and len(got) < len(rows) and stages[1].columns == P.COLUMNS


def test_secret_stage(stages):
    before = {r.doc_id: r for r in stages[1].collect()}
    after = {r.doc_id: r for r in stages[2].collect()}
    assert before.keys() == after.keys() and stages[2].columns == P.COLUMNS
    for i, r in after.items():
        spans, text, union = secret_brute(before[i].text), before[i].text, []
        for a, _, b in spans:
            if union and a < union[-1][1]:
                union[-1][1] = max(b, union[-1][1])
            else:
                union.append([a, b])
        for a, b in reversed(union):
            text = text[:a] + "[SECRET]" + text[b:]
        assert r.text == text and r.n_chars == len(r.text)
    assert any("[SECRET]" in r.text for r in after.values())


def test_mixing_stage(stages):
    before = {r.doc_id: r for r in stages[2].collect()}
    copies = Counter(r.doc_id for r in stages[3].collect())
    assert set(copies) <= set(before) and max(copies.values()) <= 3 and stages[3].columns == P.COLUMNS
    assert all(r.text == before[r.doc_id].text for r in stages[3].collect())
    total = sum(len(r.text.split()) for r in before.values())
    assert abs(sum(c * len(before[i].text.split()) for i, c in copies.items()) - total) < 0.25 * total


def test_token_stage(stages):
    from tokenizers import Tokenizer

    from foldwise.llm.bpe_trie import default_path

    lib = Tokenizer.from_file(default_path())
    text = {r.doc_id: r.text for r in stages[3].collect()}
    rows = stages[4].collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in stages[3].collect())
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").tolist() == lib.encode(text[r.doc_id], add_special_tokens=False).ids


def test_odd_rows(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [(1, long, "s"), (1, long, "s"), (None, long, "s"), (2, None, None), (None, None, None)]
    for name, f in P.STAGES:
        assert f(spark, docs_of([]), "").collect() == []
        got = f(spark, docs_of(rows, extra=("copies", "verdict", "found", "k", "id", "ids")), "").collect()
        if name == "quality_rules":
            assert len(got) == 3
        elif name == "ngram_jaccard_join":  # one row of the repeated ones
            assert Counter(r.doc_id for r in got) == {1: 1, None: 1, 2: 1}
        elif name in ("secret_scans", "bpe_encoding"):
            assert len(got) == 5


def test_mixing_keeps_draws_at_their_rows(spark, docs_of):
    """Rows with the same id, or none, get the copies that were drawn for them: all sources meet their targets."""
    from foldwise.llm.mixing import mix_sources

    # as many characters as the other source's rows have words the other way round
    rows = [(i % 7 if i % 2 else None, " ".join([f"a{i}"] * (5 + i)), "a") for i in range(120)]
    rows += [(i % 7 if i % 2 else None, " ".join([f"b{i}" + "x" * (100 - 2 * i)] * (5 + i)), "b") for i in range(40)]
    docs = docs_of(rows)
    size = Counter()
    for _, text, source in rows:
        size[source] += len(text.split())
    target = {r.source_size: r.target for r in mix_sources(docs).collect()}
    got = Counter(r.text for r in P.mixing(spark, docs, "").collect())
    assert set(got) <= {text for _, text, _ in rows}
    for source in "ab":
        mine = [text for _, text, s in rows if s == source]
        ratio = target[size[source]] / size[source]
        assert {got[t] for t in mine} <= {int(ratio), int(ratio) + 1}
        assert abs(sum(got[t] * len(t.split()) for t in mine) - target[size[source]]) < max(len(t.split()) for t in mine)


def test_run_writes_and_rereads(spark, docs_of, tmp_path):
    docs_of(corpus()).write.parquet(str(tmp_path / "documents.parquet"))
    got = P.run(spark, str(tmp_path))
    assert got.count() > 0 and {"doc_id", "n_tokens", "ids"} <= set(got.columns)


def test_near_duplicates_lose_no_other_text(spark, docs_of):
    """Rows with a shared or no doc_id are compared by their texts; of a group the smallest id stays, of equal ids always the same row."""
    rnd = random.Random(8)
    text = lambda: " ".join(rnd.choice([f"w{k}" for k in range(500)]) for _ in range(40))
    a, z, q = text(), text(), text()
    rows = [(1, a, "s"), (2, a, "s"), (2, z, "s"), (None, a, "t"), (None, q, "s1"), (None, q, "s2"), (5, "", "s"), (6, None, "s"), (None, z + " end", "u")]
    for order in (rows, rows[::-1]):
        got = [(r.doc_id, r.text, r.source) for r in P.near_duplicates(spark, docs_of(order), "").collect()]
        assert {(i, t) for i, t, _ in got} == {(1, a), (2, z), (None, q), (5, ""), (6, None)} and len(got) == 5
        kept = [s for i, t, s in got if t == q]
        assert kept == (first := kept if order is rows else first)


def test_stages_keep_no_copy_of_the_texts(spark, docs_of, tmp_path, monkeypatch):
    """Neither while a stage runs nor after it: what it keeps has no texts."""
    from foldwise.llm import work

    docs_of(corpus()).repartition(3).write.parquet(str(tmp_path / "d"))
    docs, kept, write = spark.read.parquet(str(tmp_path / "d")), [], work.write
    monkeypatch.setattr(work, "write", lambda df, path: (kept.append(df.columns), write(df, path)))
    for f in (P.near_duplicates, P.mixing):
        assert f(spark, docs, "").count() > 0
    assert kept and not [c for c in kept if "text" in c]


def test_run_holds_two_stages_at_most(spark, docs_of, tmp_path, monkeypatch):
    from foldwise.llm import work

    docs_of(corpus()).write.parquet(str(tmp_path / "documents.parquet"))
    held, write = [], work.write

    def seen(df, path):
        write(df, path)
        root = path.removeprefix("file://").rpartition("/")[0]
        if "/pipeline-" in root and "/" not in root.rpartition("/pipeline-")[2]:
            held.append(sorted(x.name for x in Path(root).glob("t*")))

    monkeypatch.setattr(work, "write", seen)
    assert P.run(spark, str(tmp_path)).count() > 0
    assert len(held) == 4 and max(map(len, held)) == 2


def test_placed(spark, docs_of, tmp_path):
    """Keys are unique and the same whatever the partitions; tables that aren't a plain read of files are written once."""
    from foldwise.llm.work import placed

    rows = corpus() + [(1, "same words", "a")] * 50 + [(None, "same words", None)] * 50
    docs_of(rows).repartition(4).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    key = lambda df: sorted(map(tuple, placed(df, "doc_id", "text").collect()), key=str)
    got = key(docs)
    assert Counter((i, t) for i, t, _ in got) == Counter((i, t) for i, t, _ in rows) and len({k for _, _, k in got}) == len(rows)
    parts, before = docs.rdd.getNumPartitions(), spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        again = spark.read.parquet(str(tmp_path / "d"))
        assert again.rdd.getNumPartitions() > parts and key(again) == got
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    twice = spark.range(2).withColumnRenamed("id", "k")
    for df in (docs.join(twice, docs.doc_id >= twice.k, "left"), docs.union(docs), docs.where("doc_id > 3"), docs_of(rows), docs_of([])):
        keys = [k for _, _, k in key(df)]
        assert len(set(keys)) == len(keys) == df.count()
