"""Quality rules: repetition coverage by rolling hashes.

Every text is measured in whole: all its words, lines and n-word windows are
hashed by numpy over the raw bytes of many texts at once, and the characters
that lie inside windows or lines met before in the same text are counted. The
state of a task is one piece of an Arrow batch (whole texts of about 1 MB
together, or one longer text); nothing is shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.textkit import LEAD, Words, buffers, pieces, repeated, spread, windows

#: published limits (fixed values): share of characters in duplicate n-grams,
#: and in duplicate lines
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
LINE_LIMIT = 0.20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

FIELDS = [
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()),
    ("dup_line_share", pa.float64()), *((f"dup_{n}gram_share", pa.float64()) for n in NGRAM_LIMITS),
]
_SQL = {pa.int64(): "bigint", pa.float64(): "double", pa.bool_(): "boolean"}
SCHEMA = "struct<" + ", ".join(f"{n}: {_SQL[t]}" for n, t in FIELDS) + ">"


def _not_first(keys: np.ndarray) -> np.ndarray:
    """True where the same key stands earlier."""
    out = np.zeros(len(keys), bool)
    at = np.flatnonzero(repeated(keys))
    if len(at):
        order = np.argsort(keys[at], kind="stable")
        s = keys[at][order]
        out[at[order[1:]]] = s[1:] == s[:-1]
    return out


def _per_doc(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[off[1:]] - c[off[:-1]]


def _covered(n_words: int, at: np.ndarray, n: int) -> np.ndarray:
    """Words inside a window of ``n`` words that begins at one of ``at``."""
    step = np.zeros(n_words + 1, np.int64)
    np.add.at(step, at, 1)
    np.subtract.at(step, at + n, 1)
    return np.cumsum(step[:-1]) > 0


def measure(w: Words) -> dict[str, np.ndarray]:
    """The figures of all texts of a piece."""
    sums = w.sums()
    h = w.range_hash(w.start, w.end, sums)
    lead = LEAD[w.data] & w.solid
    out = {"n_words": w.count.astype(np.int64), "word_chars": _per_doc(lead, w.off), "n_symbols": _per_doc(_SYMBOL[w.data], w.off)}
    salt = spread(np.arange(w.n_docs))
    total = np.maximum(out["word_chars"], 1)
    chars = np.zeros(len(lead) + 1, np.int64)
    np.cumsum(lead, out=chars[1:])

    nl = np.flatnonzero(w.data == 10)
    lines = np.bincount(np.searchsorted(w.off[1:], nl, "right"), minlength=w.n_docs) + 1  # of each text
    doc = np.repeat(np.arange(w.n_docs), lines)
    last = np.cumsum(lines) - 1
    begin = np.zeros(len(doc), np.int64)
    stop = np.zeros(len(doc), np.int64)
    inner = np.ones(len(doc), bool)
    inner[last] = False
    stop[last], stop[inner] = w.off[1:], nl
    inner[:] = True
    inner[last - lines + 1] = False
    begin[~inner], begin[inner] = w.off[:-1], nl + 1
    size = chars[stop] - chars[begin]
    some = np.flatnonzero(size > 0)
    again = _not_first(w.range_hash(begin[some], stop[some], sums) ^ salt[doc[some]])
    at = some[again]
    out["n_dup_lines"] = np.bincount(doc[at], minlength=w.n_docs).astype(np.int64)
    out["dup_line_share"] = np.bincount(doc[at], weights=size[at], minlength=w.n_docs) / total

    g, at = windows(h, w.first, 3)
    rep = at[repeated(g ^ salt[w.doc[at]])]
    out["n_repeat_words"] = np.bincount(w.doc[_covered(len(h), rep, 3)], minlength=w.n_docs).astype(np.int64)
    out["base_failed"] = (out["n_words"] < 50) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
    kept = ~out["base_failed"] & (out["dup_line_share"] <= LINE_LIMIT)
    length = (chars[w.end] - chars[w.start]).astype(np.float64)
    for n, limit in NGRAM_LIMITS.items():
        g, at = windows(h, w.first, n)
        rep = at[_not_first(g ^ salt[w.doc[at]])]
        inside = np.flatnonzero(_covered(len(h), rep, n))
        share = np.bincount(w.doc[inside], weights=length[inside], minlength=w.n_docs) / total
        out[f"dup_{n}gram_share"] = share
        kept &= share <= limit
    out["kept"] = kept
    return out


def _rules(text: pa.Array) -> pa.Array:
    data, off = buffers(text)
    parts = [measure(Words(data, off, lo, hi)) for lo, hi in pieces(off)]
    cols = [pa.array(np.concatenate([p[n] for p in parts]) if parts else [], t) for n, t in FIELDS]
    return pa.StructArray.from_arrays(cols, names=[n for n, _ in FIELDS])


def quality_rules(text: Column) -> Column:
    """Struct of the figures and verdicts of a text (see ``FIELDS``): share of
    word characters inside n-word windows, and inside lines, that stand earlier in the text.

    ``kept`` needs 50 words or more, at most half of the words inside repeated
    3-word windows, and all shares within the limits. A null or empty text has
    zero figures, fails the base rule and isn't kept. A long text is measured whole;
    repeated rows get equal figures; an empty table gives none. Only the text is read, so other columns may have any names.
    """
    return F.arrow_udf(_rules, SCHEMA)(text.cast("string"))


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", quality_rules(F.col("text")).alias("r")).select("doc_id", "r.*")


def _oracle() -> str:
    ngrams = ", ".join(
        f"""g{n} AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY doc_id, gram ORDER BY pos) AS k FROM
  (SELECT doc_id, pos, n, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS gram
   FROM t) WHERE pos <= n - {n - 1}),
c{n} AS (SELECT doc_id, sum(length(word)) AS chars FROM
  (SELECT DISTINCT doc_id, pos + i AS pos FROM g{n}, range({n}) r(i) WHERE k > 1) JOIN t USING (doc_id, pos) GROUP BY doc_id)"""
        for n in NGRAM_LIMITS)
    joins = " ".join(f"LEFT JOIN c{n} USING (doc_id)" for n in NGRAM_LIMITS)
    shares = ", ".join(f"coalesce(c{n}.chars, 0)::DOUBLE / greatest(word_chars, 1) AS dup_{n}gram_share" for n in NGRAM_LIMITS)
    verdict = " AND ".join(f"dup_{n}gram_share <= {x}" for n, x in NGRAM_LIMITS.items())
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
t AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
b AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols FROM d),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
m AS (SELECT doc_id, line, count(*) - 1 AS again, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS size
    FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line),
dl AS (SELECT doc_id, sum(again)::BIGINT AS n_dup_lines, sum(again * size) AS line_chars FROM m GROUP BY doc_id),
g3 AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, gram) AS k FROM (SELECT doc_id, pos, n,
    string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS gram FROM t) WHERE pos <= n - 2),
r3 AS (SELECT doc_id, count(DISTINCT pos + i) AS n FROM g3, range(3) r(i) WHERE k > 1 GROUP BY doc_id),
{ngrams},
s AS (SELECT b.*, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(r3.n, 0)::BIGINT AS n_repeat_words,
    coalesce(line_chars, 0)::DOUBLE / greatest(word_chars, 1) AS dup_line_share, {shares}
    FROM b LEFT JOIN dl USING (doc_id) LEFT JOIN r3 USING (doc_id) {joins})
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND dup_line_share <= {LINE_LIMIT} AND {verdict} AS kept FROM s
"""


ORACLE = _oracle()
