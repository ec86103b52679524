"""BPE encoding by a depth-first walk over the trie of distinct words.

In a byte-pair encoding, the encoding of a text ends with a token t, and what
stands before t is the encoding of the rest: so each prefix of a word has one
*last token*, and that state is enough to rebuild its encoding. The words that
a task hasn't met before are sorted, which is the depth-first order of their trie; going
from one word to the next keeps the states of the common prefix and computes
only those of new nodes, so a prefix shared by many words is encoded once.

The last token of a node is the only token that ends there, is the encoding of
its own characters, and may follow the last token of the node where it begins:
no merge across the border would have come before the merges that built the two sides.

A task holds the words of ``TOGETHER`` bytes of text (or one longer text) and a
table of about ``MAX_WORDS`` encoded words; nothing is shuffled.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldwise.llm.textkit import Words, buffers, pieces, release

MAX_WORDS = 200_000
MAX_PAIRS = 100_000
#: new words that are walked and encoded together
WALK = 16_384
#: bytes of text whose new words are walked together, and of those that are hashed at once (the arrays are some 40 times as large)
TOGETHER, HASHED = 1 << 20, 1 << 18
_NEVER = 1 << 60


def _byte_chars() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: itself
    where printable in Latin-1, else the next code point from 256 on."""
    out, free = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(free))
            free += 1
    return out


class Vocabulary:
    """A tokenizer file with byte-level symbols and an end-of-word mark."""

    def __init__(self, raw: bytes):
        from tokenizers import Tokenizer

        spec = json.loads(raw)
        model = spec["model"]
        # its normaliser and word splitting only: without the words and merges, which it would hold once more
        bare = spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": [], "post_processor": None}
        self.library = Tokenizer.from_str(json.dumps(bare))
        vocab: dict[str, int] = model["vocab"]
        mark = model["end_of_word_suffix"]
        self.token = {i: t.encode("utf-8") for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: t.encode("utf-8") for t, i in self.special.items()}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        chars = _byte_chars()
        #: symbols of a token: bytes, and bytes + 256 at the end of a word
        self.symbols: dict[int, tuple[int, ...]] = {}
        for b, c in enumerate(chars):
            for text, s in ((c, b), (c + mark, b + 256)):
                if text in vocab:
                    self.symbols[vocab[text]] = (s,)
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        self.merge: dict[tuple[int, int], int] = {}
        for r, m in enumerate(model["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            a, b, t = vocab[left], vocab[right], vocab[left + right]
            if t in self.parts:
                raise ValueError("two merges make the same token")
            self.parts[t], self.rank[t], self.merge[a, b] = (a, b), r, r
            self.symbols[t] = self.symbols[a] + self.symbols[b]
        self.length = {t: len(s) for t, s in self.symbols.items()}
        self.right: dict[int, list[tuple[int, int]]] = {}
        self.left: dict[int, list[tuple[int, int]]] = {}
        self.whole: dict[int, bool] = {}
        self.pairs: dict[int, bool] = {}
        #: tokens by their symbols from the end: node -> symbol -> node, node -> token
        self.back: list[dict[int, int]] = [{}]
        self.at: list[int] = [-1]
        for t, s in self.symbols.items():
            if self._is_whole(t):
                q = 0
                for x in reversed(s):
                    if x not in self.back[q]:
                        self.back[q][x] = len(self.back)
                        self.back.append({})
                        self.at.append(-1)
                    q = self.back[q][x]
                self.at[q] = t
        self._word_classes()
        self.rest()

    def rest(self) -> None:
        """Drop all that was learned from texts or can be built again."""
        for table in (self.left, self.right, self.whole, self.pairs):
            table.clear()
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}  # word hash -> row of the tables below
        self.flat = np.zeros(1 << 16, np.uint32)  # ids of all words
        self.used = 0
        self.start = np.zeros(1 << 12, np.int64)
        self.n = np.zeros(1 << 12, np.int64)
        self.met = np.zeros(1 << 12, np.int32)  # pieces that held the word
        self.decoded: list[bytes] = []

    def shrink(self) -> None:
        """Keep the words met in several pieces, if they are few enough."""
        old = [(h, r) for h, r in self.known.items() if self.met[r] > 1]
        start, n, flat, decoded = self.start, self.n, self.flat, self.decoded
        self.forget()
        if old and len(old) <= MAX_WORDS // 2:
            self._add([h for h, _ in old], [flat[start[r]:start[r] + n[r]] for _, r in old], [decoded[r] for _, r in old])

    def _add(self, hashes: list[int], ids: list, texts: list[bytes]) -> None:
        row, n = len(self.decoded), np.array([len(x) for x in ids], np.int64)
        new = np.concatenate([np.asarray(x, np.uint32) for x in ids]) if any(isinstance(x, np.ndarray) for x in ids) else np.array([i for x in ids for i in x], np.uint32)
        while row + len(ids) > len(self.n):
            self.start, self.n, self.met = (np.concatenate([x, np.zeros(len(x), x.dtype)]) for x in (self.start, self.n, self.met))
        while self.used + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.used:self.used + len(new)] = new
        self.n[row:row + len(ids)] = n
        self.start[row:row + len(ids)] = self.used + np.cumsum(n) - n
        self.known.update(zip(hashes, range(row, row + len(ids))))
        self.decoded.extend(texts)
        self.used += len(new)

    # --- which tokens may stand side by side

    def _spine(self, t: int, side: int) -> list[tuple[int, int]]:
        """(token, rank of the merge that takes it up) from the border byte of
        ``t`` up to ``t`` itself; side 0: its left border, 1: its right one."""
        table = (self.left, self.right)[side]
        out = table.get(t)
        if out is None:
            chain = [t]
            while chain[-1] in self.parts:
                chain.append(self.parts[chain[-1]][side])
            chain.reverse()
            out = table[t] = [(x, self.rank[chain[i + 1]] if i + 1 < len(chain) else _NEVER) for i, x in enumerate(chain)]
        return out

    def _apart(self, a: int, b: int, top: bool) -> bool:
        """Would the border between a and b stay open while both are built?
        ``top``: the merge of a and b as a whole doesn't count."""
        x, y = self._spine(a, 1), self._spine(b, 0)
        i = j = 0
        while True:
            (s, gone_s), (t, gone_t) = x[i], y[j]
            r = self.merge.get((s, t))
            # at equal ranks the left one of two overlapping pairs is merged first
            if r is not None and r < gone_s and r <= gone_t and not (top and s == a and t == b):
                return False
            if gone_s == gone_t == _NEVER:
                return True
            if gone_s <= gone_t:
                i += 1
            else:
                j += 1

    def _is_whole(self, t: int) -> bool:
        """Is t the encoding of its own characters?"""
        out = self.whole.get(t)
        if out is None:
            if t in self.parts:
                a, b = self.parts[t]
                out = self._is_whole(a) and self._is_whole(b) and self._apart(a, b, True)
            else:
                out = True
            self.whole[t] = out
        return out

    def may_follow(self, a: int, b: int) -> bool:
        if len(self.pairs) > MAX_PAIRS:
            self.pairs.clear()
        out = self.pairs[a << 32 | b] = self._apart(a, b, False)
        return out

    # --- the trie walk

    def encode_words(self, words) -> dict[bytes, list[int]]:
        """Ids of each distinct non-empty word, in one depth-first walk. ``last[k]``
        is the last token of the node reached by the first k bytes of the word."""
        out: dict[bytes, list[int]] = {}
        last = [-1]
        before = b""
        back, at, length, pairs = self.back, self.at, self.length, self.pairs
        root = back[0]
        for w in sorted(words):
            n = len(w)
            k, most = 0, min(len(last), n) - 1
            while k < most and before[k] == w[k]:
                k += 1
            del last[k + 1:]
            for i in range(k, n):
                q, j = root.get(w[i] if i < n - 1 else w[i] + 256, -1), i
                while True:  # tokens that end at this node, from the shortest
                    if q < 0:
                        raise ValueError("no token ends here")
                    t = at[q]
                    if t >= 0:
                        if j == 0:
                            break
                        ok = pairs.get(last[j] << 32 | t)
                        if ok or ok is None and self.may_follow(last[j], t):
                            break
                    j -= 1
                    q = back[q].get(w[j], -1) if j >= 0 else -1
                last.append(t)
            t = last.pop()
            ids, k = [t], n - length[t]
            while k:
                t = last[k]
                ids.append(t)
                k -= length[t]
            ids.reverse()
            out[w] = ids
            before = w
        return out

    # --- words of a chunk between ASCII white space

    def _word_classes(self) -> None:
        top = 0x180  # below it, normal form C changes nothing and the classes are settled
        group = {"L": "", "N": "", "S": ""}
        for c in map(chr, range(top)):
            kind = unicodedata.category(c)[0]
            if c in "\t\n\x0b\x0c\r \x85\xa0":
                group["S"] += re.escape(c)
            elif kind in "LN":
                group[kind] += re.escape(c)
        self.small = re.compile(f"[\x00-ſ]+")
        self.pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{group['L']}]+|[{group['N']}]|[^{group['S']}{group['L']}{group['N']}]+")

    def chunk_words(self, chunk: str) -> list[bytes]:
        low = chunk.lower()
        if self.small.fullmatch(low) and self.small.fullmatch(chunk):
            return [low.encode()] if low.isalpha() else [m.encode() for m in self.pieces.findall(low)]
        plain = self.library.normalizer.normalize_str(chunk)
        return [plain[a:b].encode() for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(plain)]

    def learn(self, hashes: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray) -> None:
        """Encode chunks that aren't known yet, given by their places: ``WALK`` at a time, neighbours in
        the alphabet together (by their first eight bytes), so memory doesn't follow the number of words of a text."""
        lead = np.frombuffer(raw + bytes(8), np.uint8)
        first = np.zeros(len(start), np.uint64)
        for k in range(8):
            first = first << np.uint64(8) | np.where(start + k < end, lead[start + k] | 32, 0).astype(np.uint64)
        order = np.argsort(first, kind="stable")
        for i in range(0, len(order), WALK):
            at = order[i:i + WALK]
            self._learn(hashes[at].tolist(), [raw[x:y] for x, y in zip(start[at].tolist(), end[at].tolist())])

    def _learn(self, hashes: list[int], chunks: list[bytes]) -> None:
        parts: list = []  # a word, or a list of words and special ids
        todo: set[bytes] = set()
        for c in chunks:
            if c.isalpha():  # ASCII letters alone
                c = c.lower()
                parts.append(c)
                todo.add(c)
                continue
            s = c.decode("utf-8")
            mine: list = []
            for x in self.split.split(s) if self.split and "<" in s else (s,):
                if x in self.special:
                    mine.append(self.special[x])
                elif x:
                    words = self.chunk_words(x)
                    mine.extend(words)
                    todo.update(words)
            parts.append(mine)
        ids = self.encode_words(todo)
        encoded = [ids[x] if isinstance(x, bytes) else [i for y in x for i in (ids[y] if isinstance(y, bytes) else (y,))] for x in parts]
        token = self.token
        self._add(hashes, encoded, [b" ".join([token[i] for i in x]) for x in encoded])

    def decode(self, ids) -> bytes:
        """Text of ids: their tokens joined by spaces (the file names no decoder); unknown ids are left out."""
        token = self.token
        return b" ".join([token[i] for i in ids if i in token])

    def encode_groups(self, data: np.ndarray, off: np.ndarray):
        """(first text, end, numbers of tokens, ids as little-endian uint32, decoded
        texts) of one group of texts after the other."""
        for lo, hi in pieces(off, TOGETHER):
            gc.disable()  # millions of small objects, no cycles among them
            counts, ids, texts = [np.zeros(0, np.int64)], [], []
            some = off[lo:hi + 1] - off[lo]
            run = data[off[lo]:off[hi]]
            held = [(a, b, Words(run, some, a, b)) for a, b in pieces(some, HASHED)]
            hashes = [w.hashes() for _, _, w in held]
            uniq, where, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
            if len(self.known) + len(uniq) > MAX_WORDS:
                self.shrink()
            known = self.known
            fresh = np.flatnonzero(np.fromiter((h not in known for h in uniq.tolist()), bool, len(uniq)))
            if len(fresh):
                at = where[fresh]
                start = np.concatenate([w.start + some[a] for a, _, w in held])[at]
                end = np.concatenate([w.end + some[a] for a, _, w in held])[at]
                self.learn(uniq[fresh], run.tobytes(), start, end)
            known = self.known
            rows = np.fromiter((known[h] for h in uniq.tolist()), np.int64, len(uniq))
            self.met[rows] += 1
            row = rows[inverse]
            done = 0
            for _, _, w in held:
                self._texts(w, row[done:done + len(w.start)], counts, ids, texts)
                done += len(w.start)
            gc.enable()
            yield lo, hi, np.concatenate(counts), ids, texts

    def encode_batch(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, list[bytes], list[bytes]]:
        groups = list(self.encode_groups(data, off))
        return np.concatenate([np.zeros(0, np.int64), *(g[2] for g in groups)]), [x for g in groups for x in g[3]], [x for g in groups for x in g[4]]

    def _texts(self, w: Words, row: np.ndarray, counts: list, ids: list, texts: list) -> None:
        n = self.n[row]
        end = np.cumsum(n)
        total = int(end[-1]) if len(end) else 0
        flat = self.flat[np.repeat(self.start[row] - (end - n), n) + np.arange(total)].astype("<u4").tobytes()
        edge = np.concatenate([[0], end])[w.first]
        counts.append(np.diff(edge))
        some = n > 0
        cut = np.concatenate([[0], np.cumsum(some)])[w.first].tolist()
        rows, edge, decoded = row[some].tolist(), (4 * edge).tolist(), self.decoded
        for d in range(w.n_docs):
            ids.append(flat[edge[d]:edge[d + 1]])
            texts.append(b" ".join([decoded[r] for r in rows[cut[d]:cut[d + 1]]]))


_LOADED: dict[str, Vocabulary] = {}


def loaded(raw: bytes) -> Vocabulary:
    """The vocabulary of a file, built once in a process."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(raw)
        release()  # the parsed file
    return _LOADED[key]


class Bpe:
    """Columns that encode and decode with a tokenizer file. The driver reads the file
    and sends it to the executors once (a fixed few MB)."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as f:
            self.file = spark.sparkContext.broadcast(f.read())

    def encode(self, text: Column) -> Column:
        """struct<n_tokens, ids (little-endian uint32), decoded> of a whole
        text, without special tokens added (those standing in the text count). A null or empty text has no tokens."""
        file = self.file

        def run(t: pa.Array) -> pa.Array:
            n, ids, texts = loaded(file.value).encode_batch(*buffers(t))
            return pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(texts, pa.binary()).cast(pa.string())], names=["n_tokens", "ids", "decoded"])

        return F.arrow_udf(run, "struct<n_tokens: bigint, ids: binary, decoded: string>")(text.cast("string"))

    def decode(self, ids: Column) -> Column:
        """Text of a binary column of little-endian uint32 ids; null for null."""
        file = self.file

        def run(col: pa.Array) -> pa.Array:
            v = loaded(file.value)
            return pa.array([None if not x.is_valid else v.decode(np.frombuffer(x.as_py(), "<u4").tolist()).decode("utf-8") for x in col], pa.string())

        return F.arrow_udf(run, "string")(ids)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encode_documents(docs: DataFrame, path: str | None = None, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns, n_tokens, ids (little-endian uint32) and decoded of each
    row; other columns aren't used. A null or empty text has no tokens. Results leave a
    task by groups of ``TOGETHER`` bytes of text, so its memory doesn't follow the size of a batch."""
    file = Bpe(docs.sparkSession, path or default_path()).file
    docs = docs.select(F.col("text").cast("string").alias("text"), *carry)
    names = [*carry, "n_tokens", "ids", "decoded"]

    def run(batches):
        release()  # what the tasks before have left in this worker
        vocabulary = loaded(file.value)
        for batch in batches:
            for lo, hi, n, ids, texts in vocabulary.encode_groups(*buffers(batch.column(0))):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(1 + k).slice(lo, hi - lo) for k in range(len(carry))), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
                     pa.array(texts, pa.binary()).cast(pa.string())], names=names)
        vocabulary.rest()
        release()

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[1:]]
    return docs.mapInArrow(run, ", ".join([*kept, "n_tokens bigint, ids binary, decoded string"]))


def op6_bpe_trie(spark, sf_dir: str) -> DataFrame:
    rows = encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return rows.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
