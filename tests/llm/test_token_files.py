import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from episodeframes.llm import token_files as T

PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rnd = random.Random(5)
    pool = [*"aBé'ÉßÀ½²9_-!.,\n\t\x1c\x85\xa0µªº×÷", "the", " ", "n't", "'S", "日本", "İ", "ﬁ", "é", "Σ", "<|endoftext|>", "😀"]
    return ["".join(rnd.choice(pool) for _ in range(rnd.randrange(60))) for _ in range(400)] + [None, "", " ", "word " * 50_000, "x" * 20_000]


def test_words_as_the_library(library):
    code = T.WordEncoder(PATH, "<u2")
    for t, ids in zip(texts(), code.encode(texts()), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == library.encode(t or "", add_special_tokens=False).ids, repr(t)[:80]


def test_cache_may_be_cleared(library, monkeypatch):
    monkeypatch.setattr(T, "MOST_BYTES", 3)
    monkeypatch.setattr(T, "WORDS_AT_ONCE", 4)
    code = T.WordEncoder(PATH, "<u2")
    for t in ("one two three four five", "six seven one", "eight"):
        assert np.frombuffer(code.encode([t])[0], "<u2").tolist() == library.encode(t, add_special_tokens=False).ids


def test_files_hold_the_corpus(spark, library):
    rows = [(i * 3 - 200, t) for i, t in enumerate(texts())]
    random.Random(6).shuffle(rows)
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, start int").repartition(3)
    want, at = [], 0
    for d, t in sorted(rows, key=lambda r: r[0]):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    manifest = T.write_token_files(df, PATH, 1, parts=5)
    assert sorted(map(tuple, T.read_digests(manifest).collect())) == [w[:4] for w in want]
    assert {(r.doc_id, r.start): r.tokens for r in T.read_tokens(manifest).collect()} == {(w[0], w[1]): w[4] for w in want}
    parts = manifest.orderBy("part").collect()
    assert [p.base for p in parts] == np.concatenate([[0], np.cumsum([p.tokens for p in parts])[:-1]]).tolist()
    offsets = T.load(parts[1].path + ".offsets", "<u8")
    assert offsets[0] == parts[1].base and len(offsets) == parts[1].docs + 1 and offsets.dtype.itemsize == 8


def test_null_and_repeated_ids_and_empty(spark):
    df = spark.createDataFrame([(None, "a"), (2, "b"), (2, "b"), (2, "c"), (None, None)], "doc_id long, text string")
    got = T.token_files_query(spark, df, PATH, 1).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 2, 2, 2] and got[0].start == 0
    assert all(b.start == a.start + a.n_tokens for a, b in zip(got[:-1], got[1:], strict=True))
    assert T.token_files_query(spark, df.limit(0), PATH, 1).collect() == []


def test_extreme_ids(spark):
    ids = [None, -(1 << 63), (1 << 63) - 1, 0, None]
    df = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(ids)], "doc_id long, text string")
    got = T.token_files_query(spark, df, PATH, 1).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -(1 << 63), 0, (1 << 63) - 1]


def test_long_texts_in_pieces(spark, library, monkeypatch):
    """Long texts are split a few words at a time, also where they clear the words that others need; reads are bounded."""
    some = ["it's one Two", "Lang " * 300 + "ende, 12 ½", "日本 " * 90, "one three"]
    want = [library.encode(t, add_special_tokens=False).ids for t in some]
    monkeypatch.setattr(T, "WHOLE", 40)
    monkeypatch.setattr(T, "WORDS_A_PIECE", 3)
    monkeypatch.setattr(T, "MOST_BYTES", 3)
    monkeypatch.setattr(T, "BLOCK_BYTES", 64)
    code = T.WordEncoder(PATH, "<u2")
    assert [np.frombuffer(x, "<u2").tolist() for x in code.encode(some)] == want
    manifest = T.write_token_files(spark.createDataFrame(list(enumerate(some)), "doc_id long, text string"), PATH, 1, parts=1)
    read = T._read_part("<u2", lambda ids, offsets, tokens, base: len(ids))
    import pyarrow as pa

    rows = pa.RecordBatch.from_pylist([r.asDict() for r in manifest.collect()])
    assert list(read([rows])) == [1, 1, 1, 1]
