import base64
import hashlib
import random
import tracemalloc

import public_tokenizers as P
import pytest
import tiktoken

from episodeframes.llm import byte_bpe

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rnd = random.Random(3)
    some = [
        "".join(
            rnd.choice(
                ["a", "b", " ", "'", "s", "é", "9", "½", "\n", "\t", "\x1c", "\xa0", "\x85", "日", "ſ", "the", "!!", "😀"]
            ) for _ in range(rnd.randrange(80))
        ) for _ in range(300)
    ]
    return [
        *some, None, "", " ", "   \n ", "it's we'll THE'S", "a" * 3000, "=" * 2000, "ab" * 500,
        "".join(rnd.choice("abcxyz0189+/") for _ in range(4000)), "word " * 300_000
    ]


def test_words_as_the_library(library):
    code = byte_bpe.Coder(RANKS, P.PATTERN)
    for text, doc in zip(texts(), code.documents(texts()), strict=True):
        words = [w for part in doc for w in part]
        assert [int(x) for w in words for x in w[0].split()] == library.encode_ordinary(text or "")
        assert b"".join(w[1] for w in words) == (text or "").encode()


def test_long_text_clears_known_words(library, monkeypatch):
    """Words that a block has learned outlive a long text before them in the block."""
    monkeypatch.setattr(byte_bpe, "MOST_BYTES", 3)
    code = byte_bpe.Coder(RANKS, P.PATTERN)
    block = ["one two three four five", "long " * 220_000, "one two three", "five"]
    for text, doc in zip(block, code.documents(block), strict=True):
        assert [int(x) for part in doc for w in part for x in w[0].split()] == library.encode_ordinary(text)


def test_long_rule_equals_plain_rule():
    code = byte_bpe.Coder(RANKS, P.PATTERN)
    rnd = random.Random(4)
    words = ["".join(rnd.choice("aabcethrs. =-") for _ in range(rnd.randrange(1, 60))).encode() for _ in range(500)]
    assert code.coded(words) == code.coded_long(words)


def test_long_words_in_rounds(library, monkeypatch):
    """Rounds of a step each, and cuts where no token crosses, change nothing."""
    code = byte_bpe.Coder(RANKS, P.PATTERN)
    rnd = random.Random(5)
    words = ["a" * 5000, "".join(rnd.choice("etaoinqzXJ") for _ in range(3000)), "".join(rnd.choice("ab") for _ in range(2000))]
    want = [" ".join(map(str, library.encode_ordinary(w))).encode() for w in words]
    for rows in (1, 20_000, byte_bpe.ROWS_A_ROUND):
        monkeypatch.setattr(byte_bpe, "ROWS_A_ROUND", rows)
        assert code.coded_long([w.encode() for w in words]) == want


def test_a_text_of_a_megabyte_after_others_fills_the_cache(spark, library, monkeypatch):
    """A small cache that is full before, within and after a block; also forgotten words that come back."""
    monkeypatch.setattr(byte_bpe, "MOST_BYTES", 2000)
    code = byte_bpe.Coder(RANKS, P.PATTERN)
    blocks = [[" ".join(f"w{i}" for i in range(84))], ["x y " * 300_000, "w", "w1 w2"], ["w1 w83", "zz"]]
    for block in blocks:
        for text, doc in zip(block, code.documents(block), strict=True):
            assert [int(x) for part in doc for w in part for x in w[0].split()] == library.encode_ordinary(text)


def test_frames(spark, library):
    rows = list(enumerate(texts())) + [(None, "null id"), (3, "again"), (3, "again")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n_tokens string").repartition(3)
    got = byte_bpe.round_trip(docs, RANKS, P.PATTERN).collect()
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    coded = byte_bpe.encode(docs, RANKS, P.PATTERN)
    back = {r.doc_id: bytes(r.bytes) for r in byte_bpe.decode(coded, RANKS, P.PATTERN).collect() if r.doc_id not in (3, None)}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts()) if i != 3}


def test_empty_table(spark):
    assert byte_bpe.round_trip(spark.createDataFrame([], "doc_id long, text string"), RANKS, P.PATTERN).collect() == []


def test_unknown_id_is_an_error(spark):
    with pytest.raises(Exception, match="an id that the ranks don't have"):
        byte_bpe.decode(spark.createDataFrame([(1, [0, 999_999])], "doc_id long, ids array<int>"), RANKS, P.PATTERN).collect()


def test_nulls_among_ids(spark):
    coded = spark.createDataFrame([(1, [0, None, 0]), (2, None), (3, []), (None, [1])], "doc_id long, ids array<int>")
    got = {r.doc_id: bytes(r.bytes) for r in byte_bpe.decode(coded, RANKS, P.PATTERN).collect()}
    assert got == {1: b"!!", 2: b"", 3: b"", None: b'"'}


def test_decode_in_a_worker_that_rested(spark, library):
    """Long documents are decoded by the workers that encoded them, in queries of bounded size."""
    rnd = random.Random(8)
    some = [" ".join(rnd.choice(["alpha", "Beta9", "gam-ma", "x"]) for _ in range(400_000)) for _ in range(3)]
    docs = spark.createDataFrame(list(enumerate(some)), "doc_id long, text string").repartition(1)
    coded = byte_bpe.encode(docs, RANKS, P.PATTERN)
    rows = coded.collect()
    assert [list(r.ids) for r in sorted(rows)] == [library.encode_ordinary(t) for t in some]
    again = spark.createDataFrame(rows, coded.schema).coalesce(1)
    for _ in range(2):
        assert {r.doc_id: bytes(r.bytes) for r in byte_bpe.decode(again, RANKS, P.PATTERN).collect()} == {i: t.encode() for i, t in enumerate(some)}


def test_rests_after_a_failed_task():
    code = byte_bpe.Coder(RANKS, P.PATTERN)
    with pytest.raises(ZeroDivisionError), code.awake():
        1 / 0
    assert "47" in code.sql.execute("SELECT current_setting('memory_limit')").fetchall()[0][0]


def plain_rule(word, ranks):
    tokens = [bytes([c]) for c in word]
    while pairs := [(ranks[x + y], i) for i, (x, y) in enumerate(zip(tokens, tokens[1:])) if x + y in ranks]:
        _, i = min(pairs)
        tokens[i : i + 2] = [tokens[i] + tokens[i + 1]]
    return b" ".join(b"%d" % ranks[x] for x in tokens)


@pytest.mark.parametrize("seed", range(4))
def test_pairs_contracted_at_once_as_the_plain_rule(tmp_path, seed):
    """Tokens in random order: many merge into tokens of lower rank, and which pair goes first matters."""
    rnd = random.Random(seed)
    letters = b"abcde"[: 2 + seed]
    more = sorted({bytes(rnd.choices(letters, k=rnd.randrange(2, 6))) for _ in range(20 + 40 * seed)})
    rnd.shuffle(more)
    ranks = {t: i for i, t in enumerate([bytes([i]) for i in range(256)] + more)}
    path = tmp_path / "ranks.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for t, i in ranks.items()))
    words = [bytes(rnd.choices(letters, k=rnd.randrange(1, 40))) for _ in range(1500)]
    assert byte_bpe.Coder(str(path), ".+").coded(words) == [plain_rule(w, ranks) for w in words]


def test_a_word_takes_few_steps():
    """One contraction a step made 19,360 rows of these 200 bytes."""
    code = byte_bpe.Coder(RANKS, P.PATTERN)
    code.sql.register("seed", code.seed([b"thing" * 40]))
    (rows,) = code.sql.execute(byte_bpe.ENCODE[: byte_bpe.ENCODE.rindex("SELECT")] + "SELECT count(*) FROM step").fetchone()
    assert rows < 1500


def test_known_words_outlive_a_task(monkeypatch):
    """Words met once are not encoded again by the next task of the same worker."""
    code = byte_bpe.Coder(RANKS, P.PATTERN)
    text = " ".join(f"word{i}" for i in range(500))
    with code.awake():
        list(code.documents([text]))
    monkeypatch.setattr(code, "coded", lambda words: pytest.fail(f"{len(words)} words again"))
    with code.awake():
        list(code.documents([text]))


def test_known_words_and_blocks_take_little(monkeypatch):
    """A known word took 290 bytes as a tuple of two, and the words of a block, one by one, 15 times its text."""
    code = byte_bpe.Coder(RANKS, P.PATTERN)
    monkeypatch.setattr(code, "coded", lambda words: [b"0"] * len(words))
    monkeypatch.setattr(code, "decoded", lambda ids: [b"!"] * len(ids))
    block = [" ".join(f"w{i % 500}" for i in range(n, n + 50_000)) for n in range(10)]
    tracemalloc.start()
    docs = code.documents(block)
    next(docs)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 5 * sum(map(len, block))
    list(docs)
    assert all(type(x) is bytes for x in code.recent.values())
