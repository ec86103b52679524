import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldwise.llm import bpe_trie as B

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(B.default_path())


def texts():
    rnd = random.Random(9)
    alphabet = "abcdefghijklmnopqrstuvwxyzABCXYZ0123456789'.,!?<>|/ \t\n\x0b\x0c\r\x1c\x85\xa0éÉñßİıΣσςǅ中文हि🙂́‍²½Ⅷ٣"
    out = [None, "", " \n", "<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|> c<|endoftext|><|endoftext|>", "it's we'll I'VE 'S ''re", "ab" * 5000, "z" * 3000]
    out += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(800)]
    out += [" ".join("".join(rnd.choice(["th", "er", "ing", "tion", "a", "on", "É"]) for _ in range(rnd.randint(1, 6))) for _ in range(50)) for _ in range(60)]
    return out


def test_equals_library(spark, docs_of, library):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in B.encode_documents(docs_of(rows, extra=("ids", "n_tokens", "decoded"))).collect()}
    for i, t in rows:
        want = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == want and got[i].n_tokens == len(want), repr(t)
        assert got[i].decoded == library.decode(want, skip_special_tokens=False)


def test_decode_column(spark, docs_of, library):
    bpe = B.Bpe(spark, B.default_path())
    df = docs_of([(1, "Hello, wörld"), (2, None)]).select("text", bpe.encode(F.col("text")).alias("r"))
    for r in df.select("text", bpe.decode(F.col("r.ids")).alias("d")).collect():
        assert r.d == library.decode(library.encode(r.text or "").ids, skip_special_tokens=False)


def test_table_stays_bounded(library, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(B, "MAX_WORDS", 300)
    v = B.loaded(open(B.default_path(), "rb").read())
    v.forget()
    for part in range(0, 800, 100):
        rows = [t or "" for t in texts()[part:part + 100]]
        _, ids, _ = v.encode_batch(*B.buffers(pa.array(rows)))
        assert [np.frombuffer(x, "<u4").tolist() for x in ids] == [library.encode(t, add_special_tokens=False).ids for t in rows]
    v.forget()


def test_empty(spark, docs_of):
    assert B.encode_documents(docs_of([])).collect() == []


def test_a_worker_holds_no_second_vocabulary_and_hashes_small_pieces(library, monkeypatch):
    import pyarrow as pa

    v = B.Vocabulary(open(B.default_path(), "rb").read())
    assert v.library.get_vocab_size() == 0
    for t in texts()[3:400]:
        plain = v.library.normalizer.normalize_str(t)
        assert plain == library.normalizer.normalize_str(t) and v.library.pre_tokenizer.pre_tokenize_str(plain) == library.pre_tokenizer.pre_tokenize_str(plain)
    sizes = []

    class Seen(B.Words):
        def __init__(self, data, offsets, lo, hi):
            sizes.append(int(offsets[hi] - offsets[lo]))
            super().__init__(data, offsets, lo, hi)

    monkeypatch.setattr(B, "Words", Seen)
    v.encode_batch(*B.buffers(pa.array(["some words of a text " * 500] * 200)))
    assert sum(sizes) == 200 * 10_500 and max(sizes) <= 1 << 18
