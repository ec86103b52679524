"""Secret scan with inferred credential grammars.

Base patterns label credentials by kind. Their formats (characters mapped to a
small class alphabet) are the strings of a prefix tree whose states are merged
while their futures agree statistically (Hoeffding bound on the frequencies of
the next symbol and of the end, applied down the subtrees), which leaves one
probabilistic automaton per kind. The long tokens of the corpus that no pattern
matched give transition counts: of every symbol after the symbols and at the
position before it, over all tokens as often as they occur. Every token of a text
that is long enough is then scored by all of them; it is a secret if its format is
far likelier under a credential automaton than as an ordinary token.

The automata of credentials are fitted on whole formats, at most about ``FIT_FORMATS``
of a kind and ``FIT_SYMBOLS`` symbols (a bounded sample of labelled rows, chosen by hash);
the counts of ordinary tokens are of all of them. Every text is scanned in
whole, and what travels to the models are formats, never secrets.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.textkit import LEAD, buffers, pieces, release, runs

KINDS = ("assign", "access", "hex")
OTHER = "other"
#: fixed values: the base patterns
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_FROM, ACCESS_FROM, HEX_FROM = 6, 20, 24
_TRIGGERS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

#: candidates are runs of credential characters of at least this length
TOKEN_FROM = 16
FIT_FORMATS = 3000
FIT_SYMBOLS = 1_000_000
FIT_LEAST = 20
ALPHA = 0.05
#: a secret's format is 10**MARGIN times likelier than as an ordinary token
MARGIN = 3.0

_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_TOKEN = np.zeros(256, bool)
_TOKEN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
_CLASS = bytes(
    ord("d") if 48 <= c < 58 else ord("h") if 97 <= c < 103 else ord("l") if 103 <= c < 123 else ord("H") if 65 <= c < 71
    else ord("U") if 71 <= c < 91 else c if c in b"+/_.=-" else ord("?") for c in range(256))
SYMBOLS = 13  # classes a format is made of, and the end
_NAMES = "dhlHU+/_.=-?"
_CODE = np.zeros(256, np.int64)  # 0 stands for what precedes a format
_CODE[list(_NAMES.encode())] = np.arange(1, SYMBOLS)
_END, _BASE = SYMBOLS, SYMBOLS + 1
#: positions that are told apart in ordinary tokens; all later ones count as the last
POSITIONS = 64


def format_of(token: bytes) -> str:
    return token.translate(_CLASS).decode("ascii")


class Automaton:
    """Deterministic probabilistic automaton; ``score`` is the log10 probability of a format."""

    FLOOR = -3.0  # of a symbol never seen in a state

    def __init__(self, moves: list[dict[str, tuple[int, float]]], end: list[float]):
        self.moves, self.end = moves, end

    def score(self, s: str) -> float:
        q, total = 0, 0.0
        for c in s:
            to = self.moves[q].get(c)
            if to is None:
                q, total = 0, total + self.FLOOR
            else:
                q, total = to[0], total + to[1]
        return total + self.end[q]

    @classmethod
    def infer(cls, strings: dict[str, int], alpha: float = ALPHA) -> "Automaton":
        """State merging on the prefix tree of ``strings`` (format -> count)."""
        kids: list[dict[str, int]] = [{}]
        flow: list[dict[str, int]] = [{}]
        stop, seen = [0], [0]
        for s, c in sorted(strings.items()):
            q = 0
            seen[0] += c
            for x in s:
                if x not in kids[q]:
                    kids[q][x] = len(kids)
                    kids.append({}), flow.append({}), stop.append(0), seen.append(0)
                flow[q][x] = flow[q].get(x, 0) + c
                q = kids[q][x]
                seen[q] += c
            stop[q] += c
        width = math.sqrt(0.5 * math.log(2 / alpha))

        def differ(f, n, g, m):
            return abs(f / n - g / m) > width * (1 / math.sqrt(n) + 1 / math.sqrt(m))

        def agree(p, q):
            todo = [(p, q)]
            while todo:
                p, q = todo.pop()
                n, m = seen[p], seen[q]
                if 1 <= width * (1 / math.sqrt(n) + 1 / math.sqrt(m)):  # the bound can't be passed here, nor further down
                    continue
                if differ(stop[p], n, stop[q], m):
                    return False
                for x in set(flow[p]) | set(flow[q]):
                    if differ(flow[p].get(x, 0), n, flow[q].get(x, 0), m):
                        return False
                    if x in kids[p] and x in kids[q]:
                        todo.append((kids[p][x], kids[q][x]))
            return True

        def fold(p, q):
            todo = [(p, q)]
            while todo:
                p, q = todo.pop()
                seen[p] += seen[q]
                stop[p] += stop[q]
                for x, c in flow[q].items():
                    flow[p][x] = flow[p].get(x, 0) + c
                for x, r in kids[q].items():
                    if x in kids[p]:
                        todo.append((kids[p][x], r))
                    else:
                        kids[p][x] = r

        kept = [0]
        while True:
            edge = [(p, x) for p in kept for x in sorted(kids[p]) if kids[p][x] not in kept]
            if not edge:
                break
            p, x = min(edge, key=lambda e: (-seen[kids[e[0]][e[1]]], e[0], e[1]))  # most evidence first
            q = kids[p][x]
            for r in kept:
                if agree(r, q):
                    kids[p][x] = r
                    fold(r, q)
                    break
            else:
                kept.append(q)
        name = {q: i for i, q in enumerate(kept)}
        moves = [{x: (name[kids[q][x]], math.log10((flow[q][x] + 0.5) / (seen[q] + 0.5 * SYMBOLS))) for x in kids[q]} for q in kept]
        return cls(moves, [math.log10((stop[q] + 0.5) / (seen[q] + 0.5 * SYMBOLS)) for q in kept])


def transitions(data: np.ndarray, off: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(level, key, count) of the symbols and ends of formats that occur ``n`` times each. Level 0 has the three
    symbols before, level 1 the two before and the position; a key is the number they make with the symbol itself."""
    size = np.diff(off) + 1
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(first, size)
    x = np.full(len(at), _END)
    x[at < np.repeat(size - 1, size)] = _CODE[data[off[0]:off[-1]]]

    def before(k):
        out = np.zeros(len(x), np.int64)
        out[k:] = x[:-k]
        return np.where(at >= k, out, 0)

    near = (before(2) * _BASE + before(1)) * _BASE + x
    times = np.repeat(n, size)
    out = []
    for level, far in enumerate((before(3), np.minimum(at, POSITIONS))):
        key, inverse = np.unique(far * _BASE ** 3 + near, return_inverse=True)
        count = np.zeros(len(key), np.int64)
        np.add.at(count, inverse, times)
        out.append((np.full(len(key), level), key, count))
    return tuple(map(np.concatenate, zip(*out)))


class Ordinary:
    """Model of ordinary tokens from all their transition counts; ``score`` is the log10 probability of a format.
    Counts at a position back off to those after three symbols, these to equal shares."""

    def __init__(self, counts: dict[tuple[int, int], int]):
        self.counts = counts
        self.totals: dict[tuple[int, int], int] = defaultdict(int)
        for (level, key), n in counts.items():
            self.totals[level, key // _BASE] += n
        self.totals = dict(self.totals)

    def score(self, s: str) -> float:
        a = b = c = 0
        total = 0.0
        for at, x in enumerate([*_CODE[list(s.encode())].tolist(), _END]):
            p = 1 / SYMBOLS
            for level, far, weight in ((0, a, 0.5 * SYMBOLS), (1, min(at, POSITIONS), SYMBOLS)):
                past = (far * _BASE + b) * _BASE + c
                p = (self.counts.get((level, past * _BASE + x), 0) + weight * p) / (self.totals.get((level, past), 0) + weight)
            total += math.log10(p)
            a, b, c = b, c, x
        return total


def _scan(data: np.ndarray, off: np.ndarray):
    """Base spans [(kind, start, end, value start, value end)] by text, and all long tokens (start, end), as byte offsets."""
    base: dict[int, list] = defaultdict(list)
    s, e = runs(_HEX[data], off)
    long = e - s >= HEX_FROM
    for a, b, d in zip(s[long].tolist(), e[long].tolist(), (np.searchsorted(off, s[long], "right") - 1).tolist()):
        base[d].append((2, a, b, a, b))
    raw = data.tobytes()
    low = raw.lower()
    for pattern, words, text in ((ASSIGN, _TRIGGERS, low), (ACCESS, (b"AKIA",), raw)):
        at = set()
        for word in words:
            i = text.find(word)
            while i >= 0:
                d = int(np.searchsorted(off, i, "right")) - 1
                at.add(d)
                i = text.find(word, i + 1)
        for d in sorted(at):
            lo, hi = int(off[d]), int(off[d + 1])
            for m in pattern.finditer(raw, lo, hi):
                if pattern is ASSIGN and m.end(2) - m.start(2) >= ASSIGN_FROM:
                    base[d].append((0, m.start(), m.end(), m.start(2), m.end(2)))
                elif pattern is ACCESS and m.end() - m.start() >= ACCESS_FROM:
                    base[d].append((1, m.start(), m.end(), m.start(), m.end()))
    s, e = runs(_TOKEN[data], off)
    long = e - s >= TOKEN_FROM
    return raw, base, s[long], e[long]


def _free(base: dict[int, list], s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Which tokens lie outside all base spans: as many spans begin before a token's end as end before its start."""
    begin = np.sort(np.array([x[1] for spans in base.values() for x in spans], np.int64))
    end = np.sort(np.array([x[2] for spans in base.values() for x in spans], np.int64))
    return np.searchsorted(begin, e, "left") == np.searchsorted(end, s, "right")


def _formats(docs: DataFrame) -> DataFrame:
    def run(batches):
        release()  # what the tasks before have left in this worker
        for batch in batches:
            data, off = buffers(batch.column(0))
            for lo, hi in pieces(off):
                d, o = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
                raw, base, s, e = _scan(d, o)
                found: dict[tuple[str, str], int] = defaultdict(int)
                for spans in base.values():
                    for k, _, _, a, b in spans:
                        found[KINDS[k], format_of(raw[a:b])] += 1
                ok = _free(base, s, e)
                for a, b in zip(s[ok].tolist(), e[ok].tolist()):
                    found[OTHER, format_of(raw[a:b])] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in found], pa.string()), pa.array([f for _, f in found], pa.string()), pa.array(list(found.values()), pa.int64())],
                    names=["kind", "format", "n"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "kind string, format string, n long")


def _ordinary(rows: DataFrame) -> Ordinary | None:
    """The model of all ordinary tokens; its table is bounded by the symbols and positions, whatever the input."""

    def run(batches):
        for batch in batches:
            data, off = buffers(batch.column(0))
            n = batch.column(1).to_numpy(zero_copy_only=False)
            for lo, hi in pieces(off):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in transitions(data, off[lo:hi + 1], n[lo:hi])], names=["level", "key", "n"])

    counts = rows.where(F.col("kind") == OTHER).select("format", "n").mapInArrow(run, "level long, key long, n long").groupBy("level", "key").agg(F.sum("n").alias("n"))
    found = {(r["level"], r["key"]): r["n"] for r in counts.collect()}
    return Ordinary(found) if found else None


def infer_grammars(docs: DataFrame, fit_formats: int = FIT_FORMATS) -> dict[str, Automaton | Ordinary]:
    """One automaton per kind with at least ``FIT_LEAST`` formats, and the model of ordinary tokens."""
    from foldwise.llm.work import Workspace

    ws = Workspace(docs.sparkSession, "grammar")
    rows = ws.keep(_formats(docs).groupBy("kind", "format").agg(F.sum("n").alias("n")))
    ordinary = _ordinary(rows)
    labelled = rows.where(F.col("kind") != OTHER)
    size = {r["kind"]: min(1.0, fit_formats / r["c"], FIT_SYMBOLS / r["l"]) for r in labelled.groupBy("kind").agg(F.count("*").alias("c"), F.sum(F.length("format")).alias("l")).collect()}
    out: dict[str, Automaton | Ordinary] = {} if ordinary is None else {OTHER: ordinary}
    if size:
        share = F.create_map(*[x for k, c in size.items() for x in (F.lit(k), F.lit(c))])
        at = F.pmod(F.xxhash64("format"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        picked: dict[str, dict[str, int]] = defaultdict(dict)
        for r in labelled.where(at < share[F.col("kind")]).toLocalIterator():
            picked[r["kind"]][r["format"]] = r["n"]
        out |= {k: Automaton.infer(v) for k, v in picked.items() if len(v) >= FIT_LEAST}
    ws.drop()
    return out


SCHEMA = ("struct<n_assign: bigint, n_access: bigint, n_hex: bigint, base_sha256: string, spans: string, n_found: bigint, "
          "cuts: array<struct<start: int, end: int>>>")


def secret_scan(docs: DataFrame, grammars: dict[str, Automaton | Ordinary], margin: float = MARGIN) -> Column:
    """Column: struct of base counts, ``base_sha256``, ``spans`` (base and
    found by format, ``kind:start:end`` by start) and ``cuts``, the union of the spans.

    Base spans always stay; a found span is a whole token outside them. A null
    or empty text has no spans. Offsets are code points, the end exclusive.
    """
    ordinary = grammars.get(OTHER)
    tests = [(k, KINDS.index(k), g) for k, g in sorted(grammars.items()) if k != OTHER]

    def found(token: str):
        best = max(((g.score(token), k) for _, k, g in tests), default=None)
        if best is None:
            return None
        plain = ordinary.score(token) if ordinary else -len(token) * math.log10(SYMBOLS)
        return best[1] if best[0] - plain >= margin else None

    def scan(text: pa.Array) -> pa.Array:
        data, off = buffers(text)
        counts, base_sha, spans, extra, cuts = [], [], [], [], []
        known: dict[str, int | None] = {}
        for lo, hi in pieces(off):
            d, o = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
            raw, base, s, e = _scan(d, o)
            points = np.zeros(len(d) + 1, np.int64)
            np.cumsum(LEAD[d], out=points[1:])
            doc = np.searchsorted(o, s, "right") - 1
            ok = _free(base, s, e)
            more: dict[int, list] = defaultdict(list)
            for a, b, i in zip(s[ok].tolist(), e[ok].tolist(), doc[ok].tolist()):
                f = format_of(raw[a:b])
                if f not in known:
                    if len(known) > 200_000:
                        known.clear()
                    known[f] = found(f)
                if known[f] is not None:
                    more[i].append((known[f], a, b))
            for i in range(hi - lo):
                mine = [(x[0], x[1], x[2]) for x in base.get(i, ())]
                counts.append([sum(x[0] == k for x in mine) for k in range(3)])

                def text_of(xs):
                    z = int(points[o[i]])
                    xs = sorted((int(points[a]) - z, k, int(points[b]) - z) for k, a, b in xs)
                    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in xs), xs

                base_text, _ = text_of(mine)
                all_text, xs = text_of(mine + more.get(i, []))
                base_sha.append(hashlib.sha256(base_text.encode()).hexdigest())
                spans.append(all_text)
                extra.append(len(more.get(i, ())))
                merged: list[dict] = []
                for a, _, b in xs:
                    if merged and a < merged[-1]["end"]:
                        merged[-1]["end"] = max(b, merged[-1]["end"])
                    else:
                        merged.append({"start": a, "end": b})
                cuts.append(merged)
        c = np.array(counts, np.int64).reshape(-1, 3)
        cols = [pa.array(c[:, 0]), pa.array(c[:, 1]), pa.array(c[:, 2]), pa.array(base_sha, pa.string()), pa.array(spans, pa.string()),
                pa.array(extra, pa.int64()), pa.array(cuts, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))]
        return pa.StructArray.from_arrays(cols, names=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_found", "cuts"])

    return F.arrow_udf(scan, SCHEMA)(F.col("text").cast("string"))


def redacted(text: Column, cuts: Column, mark: str = "[SECRET]") -> Column:
    """The text with every cut replaced by ``mark``."""
    step = F.aggregate(
        cuts, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, x: F.struct(F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark)).alias("out"), x["end"].alias("at")))
    return F.when(F.size(cuts) > 0, F.concat(step["out"], F.substring(text, step["at"] + 1, F.length(text)))).otherwise(text)


def op9_secret_grammar(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scan = secret_scan(docs, infer_grammars(docs))
    return docs.select("doc_id", scan.alias("r")).select("doc_id", "r.n_assign", "r.n_access", "r.n_hex", "r.base_sha256", "r.spans", "r.n_found")
