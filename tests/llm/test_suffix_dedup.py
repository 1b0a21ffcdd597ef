import hashlib
import random

import numpy as np
import pytest

from episodeframes.llm import suffix_dedup as S


def brute(rows):
    first = {}
    for d, t in rows:
        raw = (t or "").encode()
        for i in range(len(raw) - 49):
            w = raw[i : i + 50]
            first[w] = min(first.get(w, d), d)
    for d, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < d:
                gone[i : i + 50] = True
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        yield d, len(raw), int(gone.sum()), runs, hashlib.sha256(bytes(b for b, g in zip(raw, gone) if not g)).hexdigest()


def corpus(rnd, n):
    def words(k):
        return " ".join("".join(rnd.choice("abé") for _ in range(rnd.randrange(1, 6))) for _ in range(k))

    passages = [words(k) for k in (8, 15, 30, 60, 200)]
    rows = []
    for d in range(n):
        t = words(rnd.randrange(0, 80))
        for _ in range(rnd.choice([0, 1, 1, 2])):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p) // 2)
            t = t[: (c := rnd.randrange(len(t) + 1))] + p[a : a + rnd.randrange(len(p))] + t[c:]
        if rows and rnd.random() < 0.2:
            t = rows[-1][1]
            if t and rnd.random() < 0.7:
                c = rnd.randrange(len(t))
                t = t[:c] + "#" + t[c + 1 :]
        rows.append((d, t))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("common", [16, 2])
def test_against_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(S, "COMMON", common)
    rows = corpus(random.Random(9), 250) + [
        (900, None), (901, ""), (902, "x" * 49), (903, "x" * 50), (904, "x" * 51), (905, "ab" * 2000), (906, "ha " * 500)
    ]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, th int").repartition(5)
    got = sorted(map(tuple, S.cut_repeats(df).collect()))
    want = sorted(brute(rows))
    assert got == want
    assert sum(w[2] > 0 for w in want) > 50


def test_common_line_twice_with_a_smaller_document_elsewhere(spark):
    """A task's one row for a common gram is repeated in another task: the gram's other places must be compared all the same."""
    rnd = random.Random(12)

    def some(n):
        return "".join(rnd.choice("abcdefgh ") for _ in range(n))

    lines = [some(100) for _ in range(8)]
    near = [(some(60), some(60)) for _ in lines]
    far = [(some(60), some(60)) for _ in lines]
    y = some(40).join(
        a + p + b for p, (a, b) in zip(lines, near, strict=True)
    ) + some(40).join(a + p + b for p, (a, b) in zip(lines, far, strict=True))
    x = some(40).join(a + p + b + some(70) + p + some(70) for p, (a, b) in zip(lines, near, strict=True))
    z = some(40).join(a + p + some(70) for p, (a, _) in zip(lines, far, strict=True))
    others = [(d, some(40).join(some(60) + p + some(60) for p in lines)) for d in range(10, 10 + 2 * S.COMMON)]
    here = [(2, x), (3, z), *others]
    there = [(1, y), *((1000 + d, some(60)) for d, _ in here[1:])]
    df = spark.createDataFrame(spark.sparkContext.parallelize(there + here, 2), "doc_id long, text string")
    assert sorted(map(tuple, S.cut_repeats(df).collect())) == sorted(brute(there + here))


def test_local_rules_alone():
    """The task-local rules see a shared gram in many stretches and still send one row."""
    rnd = random.Random(10)
    p = "".join(rnd.choice("abc") for _ in range(90))
    texts = [("".join(rnd.choice("xyz") for _ in range(60)) + p + "".join(rnd.choice("xyz") for _ in range(60))).encode() for _ in range(200)]
    data, at = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    kh, ctx, doc, s, n = S.stretches(data, at)
    out = list(S.gather_1(kh, ctx, doc.astype(np.int64), np.zeros(len(kh), np.int32), s, n, 8))
    sent = sum(sum(x for x in b.column(2).to_pylist() if x) for b in out)
    assert sent < len(kh) and n.sum() == sum(len(t) - 49 for t in texts)


def test_long_texts_in_pieces(spark, monkeypatch):
    rnd = random.Random(11)
    long = "".join(rnd.choice("abcdefgh") for _ in range(9000))
    rows = [(1, long), (2, long[1000:5000] + "!" + long[2000:2100]), (3, "q" + long[-2000:])]
    monkeypatch.setattr(S, "PIECE", 512)
    at = np.array([0, 9000])
    found = [S.stretches(np.frombuffer(long.encode(), np.uint8), b) for _, b, _ in S.pieces(at)]
    assert sum(f[4].sum() for f in found) == 9000 - 49
    assert sorted(map(tuple, S.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == sorted(brute(rows))


def test_null_and_repeated_ids(spark):
    t = "some text that is quite long enough to hold a window of fifty bytes, twice. " * 2
    rows = [(1, t), (1, t), (1, t + "more"), (None, t), (None, t), (2, t)]
    got = S.cut_repeats(spark.createDataFrame(rows, "doc_id long, text string"), keep_text=True).collect()
    assert sorted((r.doc_id or 99, r.n_removed) for r in got) == [(1, 0), (1, 0), (1, 0), (2, len(t)), (99, len(t)), (99, len(t))]
    assert {bytes(r.kept_bytes) for r in got} == {t.encode(), (t + "more").encode(), b""}
    assert S.cut_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_rows_without_an_id_and_the_largest_id(spark):
    """Rows without an id are told apart by their texts, copies of one row add nothing, and the largest id comes back."""
    passage = "a passage of more than fifty bytes that several documents have"
    rows = [(1, passage + " one"), (None, "two " + passage), (None, "three, " + passage), ((1 << 63) - 1, "own text of the largest id, which nobody shares with it")]
    rows += [(5, "five " + passage)] * 30 + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(str, (tuple(r)[:4] for r in S.cut_repeats(df).collect())))
    n = len(passage)
    want = [(1, n + 4, 0, 0), (None, n + 4, n + 1, 1), (None, n + 7, n + 1, 1), ((1 << 63) - 1, len(rows[3][1]), 0, 0), (None, 0, 0, 0)] + [(5, n + 5, n, 1)] * 30
    # the blank before the passage is in document 5, not in document 1
    assert got == sorted(map(str, want))
