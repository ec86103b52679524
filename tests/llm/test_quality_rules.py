import random
import re

from pyspark.sql import functions as F

from foldwise.llm.quality_rules import LINE_LIMIT, NGRAM_LIMITS, quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(s):
    s = s or ""
    w = WORD.findall(s)
    chars = sum(map(len, w))
    seen, dup, dup_chars = set(), 0, 0
    for line in s.split("\n"):
        if WORD.search(line):
            if line in seen:
                dup += 1
                dup_chars += sum(map(len, WORD.findall(line)))
            seen.add(line)
    at = {}
    for k in range(len(w) - 2):
        at.setdefault(tuple(w[k:k + 3]), []).append(k)
    rep = {k + j for v in at.values() if len(v) > 1 for k in v for j in range(3)}
    failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
    kept = not failed and dup_chars / max(chars, 1) <= LINE_LIMIT
    for n, limit in NGRAM_LIMITS.items():
        old, cover = set(), set()
        for k in range(len(w) - n + 1):
            g = tuple(w[k:k + n])
            if g in old:
                cover.update(range(k, k + n))
            old.add(g)
        kept = kept and sum(len(w[k]) for k in cover) / max(chars, 1) <= limit
    return len(w), chars, sum(c in "#*$%&|<>" for c in s), dup, len(rep), failed, kept


def test_against_brute_force(spark, docs_of):
    rnd = random.Random(4)
    texts = [None, "", "\n\n", " a", "#|<é>\n#|<é>\n", "x" * 50_000, "été " * 60, "a\x0bb\x0cc\x1cd"]
    for _ in range(150):
        words = [rnd.choice(["a", "bé", "ccc", "#d", "中文", "e f"]) + str(rnd.randint(0, rnd.choice([3, 60, 2000]))) for _ in range(rnd.randint(1, 200))]
        texts.append("".join(x + rnd.choice([" ", " ", "\n", "  \t", "\r\n"]) for x in words) * rnd.choice([1, 1, 2]))
    df = docs_of(list(enumerate(texts)), extra=("n_words", "kept"))
    rows = df.select("doc_id", quality_rules(F.col("text")).alias("r")).select("doc_id", "r.*").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == brute(texts[r.doc_id])


def test_empty(spark, docs_of):
    assert docs_of([]).select(quality_rules(F.col("text")).alias("r")).collect() == []
