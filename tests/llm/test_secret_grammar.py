import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from foldwise.llm.secret_grammar import KINDS, Automaton, Ordinary, format_of, infer_grammars, redacted, secret_scan, transitions
from foldwise.llm.textkit import buffers

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(s):
    s = s or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(s) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", s) if len(m[0]) >= 20]
    return sorted(out + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", s) if len(m[0]) >= 24])


def key(rnd, head, n=16):
    return head + "".join(rnd.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(n))


def corpus():
    rnd = random.Random(8)
    words = ["thering", "ofwhich", "andanotherwordthatisratherlong", "été", "x1", "4716253647586970"]
    rows = []
    for i in range(200):
        body = [rnd.choice(words) for _ in range(20)]
        body.insert(5, key(rnd, "AKIA"))
        body.insert(9, 'API_Key = "' + "".join(rnd.choice("0123456789abcdef") for _ in range(40)) + '"')
        rows.append((i, " ".join(body)))
    rows += [(200, "é hidden " + key(rnd, "ASIA") + " end"), (201, "plain words thatareverylongbutordinary 4716253647586970"), (202, None), (203, ""),
             (204, "PASSWORD: abcdef secret=abc token='x.y-z/+=' deadbeefdeadbeefdeadbeef"), (204, "dup"), (None, "AKIA" + "A" * 16), (205, "a" * 100_000)]
    return rows


def scan(df):
    return df.select("doc_id", "text", secret_scan(df, infer_grammars(df)).alias("r"))


def test_base_and_found(spark, docs_of):
    rows = corpus()
    out = scan(docs_of(rows, extra=("spans", "kind", "format", "n"))).collect()
    assert len(out) == len(rows)
    for r in out:
        want = brute(r.text)
        text = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r.r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.r.n_assign, r.r.n_access, r.r.n_hex) == tuple(sum(k == j for _, k, _ in want) for j in range(3))
        assert set(filter(None, text.split(","))) <= set(r.r.spans.split(","))
    by = {r.doc_id: r for r in out}
    assert by[200].r.n_found == 1 and by[200].r.spans == "access:9:29"  # a key format that no base pattern has
    assert by[201].r.n_found == 0 and sum(r.r.n_found for r in out) == 1


def test_redaction(spark, docs_of):
    df = scan(docs_of(corpus())).withColumn("clean", redacted(F.col("text"), F.col("r.cuts")))
    for r in df.collect():
        cuts = [(c.start, c.end) for c in r.r.cuts]
        want = r.text
        for a, b in reversed(cuts):
            want = want[:a] + "[SECRET]" + want[b:]
        assert r.clean == want and not brute(r.clean)


def test_automaton_is_a_distribution_and_prefers_its_formats():
    rnd = random.Random(1)
    train = {format_of(key(rnd, "AKIA").encode()): 1 for _ in range(300)}
    a = Automaton.infer(train)
    assert len(a.moves) < 60  # merged far below the prefix tree
    for moves, end in zip(a.moves, a.end):
        assert sum(10 ** p for _, p in moves.values()) + 10 ** end <= 1 + 1e-9
    held = [format_of(key(rnd, "AKIA").encode()) for _ in range(100)]
    other = [format_of("".join(rnd.choice("ghijklmnop") for _ in range(20)).encode()) for _ in range(100)]
    assert min(map(a.score, held)) > max(map(a.score, other))


def test_empty(spark, docs_of):
    assert scan(docs_of([])).collect() == []


def test_ordinary_tokens_all_count(spark, docs_of):
    """The model of ordinary tokens is of all tokens, as often as they occur, at every sample size and in whole length."""
    rnd = random.Random(5)
    digits, tail = "d" * 16, "l" * 300
    words = [("".join(rnd.choice("ghij0123KLMN_-") for _ in range(rnd.randint(16, 24)))) for _ in range(400)]
    tokens = words + ["".join(rnd.choice("0123456789") for _ in range(16)) for _ in range(400)] + ["z" * 300] * 50
    keys = ["token=" + "".join(rnd.choice("0123456789") for _ in range(16)) for _ in range(30)] + [f"secret={key(rnd, 'x')}" for _ in range(60)]
    docs = docs_of([(i, t) for i, t in enumerate(tokens + keys)])
    few, all_ = infer_grammars(docs, 25), infer_grammars(docs)
    assert all(few["other"].score(f) == all_["other"].score(f) for f in (digits, tail, format_of(words[0].encode())))
    assert few["other"].score(digits) > -1.0 and few["other"].score(tail) > -10.0
    found = docs.select("doc_id", secret_scan(docs, few).alias("r")).where("doc_id >= 400 and doc_id < 800 and r.n_found > 0")
    assert found.count() == 0


def test_ordinary_is_a_distribution_of_the_counts():
    formats = {"dd": 3, "dhl": 2, "l" * 70: 1}
    data, off = buffers(pa.array(list(formats)))
    level, k, n = transitions(data, off, np.array(list(formats.values())))
    model = Ordinary({(a, b): c for a, b, c in zip(level.tolist(), k.tolist(), n.tolist())})
    assert n[level == 0].sum() == n[level == 1].sum() == 3 * 3 + 4 * 2 + 71
    for start in ("", "d", "dh", "l" * 69, "U?"):
        ends = 10 ** model.score(start)
        longer = [sum(10 ** model.score(start + a) for a in "dhlHU+/_.=-?")]
        assert 0 < ends + longer[0] <= 1 + 1e-9


def test_many_secrets_in_one_text_take_seconds():
    import time

    import numpy as np

    from foldwise.llm import secret_grammar as sg

    text = "".join(f"zz{i:016d}q word token = abz{i:016d}xyz, " for i in range(50_000)).encode()
    data, off = np.frombuffer(text, np.uint8), np.array([0, len(text)])
    _, base, s, e = sg._scan(data, off)
    began = time.time()
    ok = sg._free(base, s, e)
    assert time.time() - began < 5 and sum(map(len, base.values())) == 50_000
    spans = sorted((x[1], x[2]) for x in base[0])
    for i in np.random.default_rng(1).integers(0, len(s), 300):
        assert ok[i] == all(e[i] <= a or s[i] >= b for a, b in spans)
