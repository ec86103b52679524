"""Personal data with offset-preserving deobfuscation.

The base patterns run on the text as it is. A text that shows signs of a
disguise also goes through a transducer: homoglyphs, foreign digits and
full-width forms become ASCII, invisible characters go, spelled digits become
digits, and written or bracketed at / dot / plus become their signs. For every
character of its output the transducer keeps the source span it was read from, so a
span found in the output is mapped back to the characters of the source.

Texts are examined by numpy over the raw bytes of a whole piece first; only texts
that can hold an identifier reach the patterns. Nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldwise.llm.textkit import buffers, pieces, runs

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: fixed values: the base patterns (an e-mail's local part is read backwards from its sign)
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def identifiers(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), leftmost and non-overlapping in each kind."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
            done = m.end()
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 16 <= len(d) <= 19 and luhn(d):
            out.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            out.append((3, m.start(), m.end()))
    return out


#: spelled digits (fixed values)
SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
#: letters of other scripts that look like ASCII ones (fixed values)
LOOKALIKE = dict(zip("аеорсухіјѕԁһӏАВЕКМНОРСТХУІЈЅοαινρυΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdhlABEKMHOPCTXYIJSoaivpuABEZHIKMNOPTYX")) | {"ı": "i", "İ": "I", "ſ": "s", "\u212a": "K"}
_MARKS = {"。": ".", "．": ".", "‧": ".", "․": ".", "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-", "﹫": "@"}
_HIDDEN = "­​‌‍⁠﻿"
_WORD = "(?:(?:double|triple)[ -]{1,3})?(?:" + "|".join(SPELLED) + ")"
#: common words (fixed values): as the last label of "x at y dot z" they need the end of a line or a sign of punctuation behind them,
#: or "look at the dot of it" would be an address; any other word of two or more letters needs nothing
_NO_ENDS = ("of|on|or|an|the|and|to|is|was|were|are|that|this|these|those|there|then|than|with|from|for|by|as|if|but|not|we|he|she|you|they|his|her|their|our|its|"
            "which|when|where|while|who|what|will|would|can|could|has|had|have|do|does|did|into|onto|over|under|so|because|before|after|again|also")
_SEP = r"[ ,.-]{0,3}(?:dot|point)?[ ,.-]{1,3}"  # between two spelled digits
_SIDE = r"[ ,.()-]{0,3}(?:(?:dot|point)[ ,.-]{1,3})?"  # between a spelled digit and a digit
_DOT = " {1,3}(?:dot|punkt|punto) {1,3}"
_OPEN, _SHUT = r"\s{0,3}[(\[{<]\s{0,3}", r"\s{0,3}[)\]}>]\s{0,3}"


@lru_cache(1)
def _table() -> dict[str, str]:
    """Characters that stand for an ASCII one: full-width forms, decimal
    digits of all scripts, spaces, look-alikes; hidden ones stand for nothing."""
    out = {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    for c in range(128, sys.maxunicode + 1):
        x = chr(c)
        kind = unicodedata.category(x)
        if kind == "Nd":
            out[x] = str(unicodedata.decimal(x))
        elif kind == "Zs":
            out[x] = " "
    return out | LOOKALIKE | _MARKS | {c: "" for c in _HIDDEN}


@lru_cache(1)
def _passes() -> list[tuple[re.Pattern, object]]:
    """The transducers, in order: pattern and output for a match."""
    table = _table()
    single = re.compile("[" + "".join(map(re.escape, sorted(table))) + "]")
    spelled = re.compile(rf"(?P<left>(?<=[0-9]){_SIDE})?(?<![A-Za-z])(?P<words>(?P<plus>plus[ -]{{1,3}})?{_WORD}(?:{_SEP}{_WORD})*)(?![A-Za-z])(?P<right>{_SIDE}(?=[0-9]))?", re.I)
    word = re.compile(rf"plus|dot|point|{_WORD}|(?<=[a-z])\.(?=[a-z])", re.I)
    side = re.compile(r"dot|point|[.()-]| +", re.I)

    def spoken(w: str) -> str:
        """Digits of a spelled one, with "double" or "triple" before it."""
        times = {"d": 2, "t": 3}[w[0]] if w.startswith(("double", "triple")) else 1
        return SPELLED.get(re.split("[ -]+", w)[-1], "") * times

    def digits(m: re.Match) -> list[tuple[str, int, int]] | None:
        """Four and more spelled digits in a row count, fewer if they touch digits or a plus."""
        found = list(word.finditer(m["words"]))
        few = sum(len(spoken(x.group().lower())) for x in found) < 4
        if few and m["left"] is None and m["right"] is None and not m["plus"] and m.string[m.start() - 1:m.start()] != "+":
            return None
        out = []

        def beside(name: str) -> None:
            s, at = m[name] or "", m.start(name) - m.start()
            said = re.search("dot|point", s, re.I)
            for x in [said] if said else side.finditer(s):
                out.append(("." if said else x.group()[0], at + x.start(), at + x.end()))

        beside("left")
        at = m.start("words") - m.start()
        for x in found:
            w = x.group().lower()
            if w != "." or few:
                signs = "+" if w == "plus" else "." if w in ("dot", "point", ".") else spoken(w)
                out.extend((c, at + x.start(), at + x.end()) for c in signs)
        beside("right")
        return out

    return [
        (single, lambda m: table[m.group()]),
        (spelled, digits),
        (re.compile(rf"{_OPEN}(?:at|@){_SHUT}", re.I), "@"),
        (re.compile(rf"{_OPEN}(?:dot|punkt|punto|point|\.){_SHUT}", re.I), "."),
        (re.compile(rf"(?<=[A-Za-z0-9]) {{1,3}}at {{1,3}}(?=[A-Za-z0-9-]+(?:(?:{_DOT}|\.)[A-Za-z0-9-]+)*?{_DOT}(?!(?:{_NO_ENDS})(?![A-Za-z0-9-])(?!\s*(?:[\n,;:!?)\].]|$)))(?:xn--[a-z0-9-]+|[a-z]{{2,}})(?![A-Za-z]))", re.I), "@"),
        (re.compile(rf"(?<=[A-Za-z0-9-]){_DOT}(?=[A-Za-z0-9-])", re.I), "."),
        (re.compile(r"(?<![A-Za-z0-9])(?=[OolI]*[0-9])(?=[0-9]*[OolI])[0-9OolI]+(?![A-Za-z0-9])"),
         lambda m: [({"O": "0", "o": "0", "l": "1", "I": "1"}.get(c, c), i, i + 1) for i, c in enumerate(m.group())]),
    ]


class Tape:
    """A text with the source span of each of its characters."""

    def __init__(self, text: str):
        self.text = text
        self.start = np.arange(len(text))
        self.end = self.start + 1

    def run(self, pattern: re.Pattern, output) -> None:
        parts, starts, ends, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            a, b = m.span()
            got = output if isinstance(output, str) else output(m)
            if got is None:  # stays as it is
                continue
            parts.append(self.text[at:a])
            starts.append(self.start[at:a])
            ends.append(self.end[at:a])
            for c, x, y in got if isinstance(got, list) else [(got, 0, b - a)] if got else []:
                parts.append(c)
                starts.append(self.start[a + x:a + x + 1])
                ends.append(self.end[a + y - 1:a + y])
            at = b
        if at:
            parts.append(self.text[at:])
            starts.append(self.start[at:])
            ends.append(self.end[at:])
            self.text, self.start, self.end = "".join(parts), np.concatenate(starts), np.concatenate(ends)


def _last(spans: list[tuple[int, int]], before: int) -> tuple[int, int]:
    """The last of sorted, disjoint spans that starts before a place."""
    i = bisect_left(spans, (before,))
    return spans[i - 1] if i else (-1, -1)


def hidden_identifiers(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans that only the transduced text shows, in source characters. One may hold or cut a base span (the
    whole identifier of which the base pattern saw a piece), but none lies inside a base span or overlaps an earlier hidden one."""
    tape = Tape(text)
    for pattern, output in _passes():
        tape.run(pattern, output)
    if tape.text == text:
        return []
    mine: list[list[tuple[int, int]]] = [[] for _ in KINDS]
    theirs = [sorted((a, b) for j, a, b in base if j == k) for k in range(len(KINDS))]
    for k, a, b in sorted(identifiers(tape.text), key=lambda x: (x[0], x[1])):
        a, b = int(tape.start[a]), int(tape.end[b - 1])
        inside = any(b <= _last(x, a + 1)[1] for x in theirs)
        if not inside and not any(a < _last(x, b)[1] for x in mine):
            mine[k].append((a, b))
    return [(k, a, b) for k, x in enumerate(mine) for a, b in x]


#: what the transducers' patterns begin with, on lower-cased bytes. What follows the first sign or word is looked at
#: only, so a match that runs into the next text hides none there
_GAP = rb"(?:[\s\x1c-\x1f]|\xc2\x85){0,3}"
_SAID = re.compile(rb" (?:dot|punkt|punto) ")
_BRACKET = re.compile(rb"[(\[{<](?=" + _GAP + rb"(?:at|@|dot|punkt|punto|point|\.)" + _GAP + rb"[)\]}>])")
_SPOKEN = re.compile(rf"{_WORD}(?={_SEP}{_WORD}|{_SIDE}[0-9])".encode())
_BESIDE = re.compile(rf"[0-9](?={_SIDE}{_WORD})|\+(?={_WORD})|plus(?=[ -]{{1,3}}{_WORD})".encode())


def _suspects(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which texts can hold a base identifier, and which show a disguise."""
    digit = (data >= 48) & (data < 58)
    n = len(off) - 1
    s, e = runs(digit, off)
    doc = np.searchsorted(off, s, "right") - 1
    n_digits = np.bincount(doc, weights=e - s, minlength=n)
    sign = np.zeros(n, bool)
    for c in (64, 43):
        sign[np.searchsorted(off, np.flatnonzero(data == c), "right") - 1] = True
    base = sign | (n_digits >= 4)
    odd = np.zeros(n, bool)
    # two-byte leads beyond the Latin letters, no-break space, soft hyphen, letters whose other case is i or s, and three- and four-byte characters
    lead = (data >= 0xCC) | (data == 0xC4) | (data == 0xC5)
    after = np.zeros(len(data), np.uint8)
    after[:-1] = data[1:]
    lead |= (data == 0xC2) & ((after == 0xA0) | (after == 0xAD))
    odd[np.searchsorted(off, np.flatnonzero(lead), "right") - 1] = True
    letter = (data == 79) | (data == 111) | (data == 108) | (data == 73)
    before = np.zeros(len(data), bool)
    before[1:] = digit[:-1]
    next_ = np.zeros(len(data), bool)
    next_[:-1] = digit[1:]
    odd[np.searchsorted(off, np.flatnonzero(letter & (before | next_)), "right") - 1] = True
    low = data.tobytes().lower()
    found = [m.start() for pattern in (_BRACKET, _SPOKEN, _BESIDE, _SAID) for m in pattern.finditer(low)]
    odd[np.searchsorted(off, found, "right") - 1] = True
    return base, odd


def _text_of(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


FIELDS = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_hidden"]
SCHEMA = "struct<n_email: bigint, n_ip: bigint, n_card: bigint, n_phone: bigint, base_sha256: string, spans: string, n_hidden: bigint>"


def _scan(text: pa.Array) -> pa.Array:
    data, off = buffers(text)
    counts, sha, spans, hidden = [], [], [], []
    empty = hashlib.sha256(b"").hexdigest()
    for lo, hi in pieces(off):
        d, o = data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        base_at, odd = _suspects(d, o)
        raw = d.tobytes()
        for i in range(hi - lo):
            if not (base_at[i] or odd[i]):
                counts.append((0, 0, 0, 0)), sha.append(empty), spans.append(""), hidden.append(0)
                continue
            s = raw[o[i]:o[i + 1]].decode("utf-8")
            base = identifiers(s) if base_at[i] else []
            more = hidden_identifiers(s, base) if odd[i] else []
            counts.append(tuple(sum(x[0] == k for x in base) for k in range(4)))
            sha.append(hashlib.sha256(_text_of(base).encode()).hexdigest() if base else empty)
            spans.append(_text_of(base + more))
            hidden.append(len(more))
    c = np.array(counts, np.int64).reshape(-1, 4)
    return pa.StructArray.from_arrays(
        [*(pa.array(c[:, k]) for k in range(4)), pa.array(sha, pa.string()), pa.array(spans, pa.string()), pa.array(hidden, pa.int64())], names=FIELDS)


def personal_data(text: Column) -> Column:
    """Struct of the base counts, ``base_sha256`` and ``spans`` (base and hidden ones as
    ``kind:start:end``, by kind and start; offsets in code points, the end exclusive).

    Base spans always stay; a hidden span may hold one, but never lies inside one or overlaps another hidden one. A null or
    empty text has no spans. A long text is searched whole; repeated rows get equal spans; an empty table gives none. Only the text is
    read, so other columns may have any names. "x at y.z" without a spoken dot is left alone ("see us at example.com").
    """
    return F.arrow_udf(_scan, SCHEMA)(text.cast("string"))


def op8_pii_offsets(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", personal_data(F.col("text")).alias("r")).select("doc_id", "r.*")
