import random
import re

import numpy as np

from episodeframes.llm import minhash_dedup as M
from episodeframes.llm.common import utf8

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), d), d)
    return sorted((d, len(sets[i]), least[top(i)], d == least[top(i)]) for i, (d, _) in enumerate(rows))


def corpus(rnd, n):
    rows, vocabulary = [], ["".join(rnd.choice("abcdé") for _ in range(4)) for _ in range(300)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    while len(rows) < n:
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 120))]
        if rnd.random() < 0.3:
            words[5:5] = passage
        for _ in range(rnd.choice([1, 1, 2, 5])):
            rows.append((len(rows), rnd.choice([" ", "\n", "\t "]).join(words).upper() if rnd.random() < 0.2 else " ".join(words)))
            words = list(words)
            for _ in range(rnd.choice([0, 1, 2, 5])):
                words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
    return rows


def test_against_brute_force(spark):
    rows = corpus(random.Random(6), 400) + [
        (1000, None), (1001, ""), (1002, " \n"), (1003, "one"), (1004, "ONE"), (1005, "a b"), (1006, "\xa0 x"), (1007, "long " * 40_000),
        (1008, "long " * 40_001)
    ]
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, kept string, v int").repartition(3)
    got = sorted(map(tuple, M.near_duplicates(df).collect()))
    assert got == brute(rows)
    left = M.drop_near_copies(df)
    assert left.columns == df.columns
    assert sorted(r.doc_id for r in left.collect()) == [r[0] for r in brute(rows) if r[3]]


def test_large_group_in_blocks(spark, monkeypatch):
    """A group of near copies in many buckets and blocks, near the threshold: the components are exact."""
    for name, value in (("BLOCK", 8), ("BLOCK_TEXT", 1 << 20)):
        monkeypatch.setattr(M, name, value)
    rnd = random.Random(12)
    base = [f"w{i}" for i in range(90)]
    rows = []
    for d in range(120):
        words = list(base)
        for _ in range(rnd.choice([0, 1, 2, 3, 4])):
            words[rnd.randrange(len(words))] = f"x{rnd.randrange(10**6)}"
        rows.append((d, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, M.near_duplicates(df).collect())) == brute(rows)


def test_may_link_across_components_only():
    rng = np.random.default_rng(13)
    sig = rng.integers(0, 256, (6, M.COORDINATES)).astype(np.uint8)
    sig[1] = sig[2] = sig[4] = sig[0]
    c = np.array([0, 0, 2, 3, 4, 5])
    found = M.may_link(c, np.zeros(6, np.int64), sig)
    assert np.argwhere(np.triu(found)).tolist() == [[0, 2], [0, 4], [1, 2], [1, 4], [2, 4]]
    assert M.smallest_reached(found).tolist() == [0, 0, 0, 3, 0, 5]
    found = M.may_link(c, np.array([0, 1, 1, 1, 0, 1]), sig)
    assert np.argwhere(np.triu(found)).tolist() == [[0, 2], [1, 4], [2, 4]]


def test_repeated_rows_nulls_and_empty(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (None, None), (2, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = M.near_duplicates(df).collect()
    assert sorted(str((r.doc_id, r.component_id, r.kept)) for r in got) == sorted(
        map(str, [(1, 1, True), (1, 1, True), (None, 1, False), (None, None, True), (None, None, True), (2, 2, True)])
    )
    assert sorted(map(str, map(tuple, M.drop_near_copies(df).collect()))) == sorted(
        map(str, [(1, "a b c d e f"), (None, None), (None, None), (2, "")])
    )
    assert M.near_duplicates(df.limit(0)).collect() == []


def test_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "p long, v long")
    got = {r.v: r.c for r in M.components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_sketch_estimates_and_fills():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 2**63, 2000).astype(np.uint64)
    a, b = np.unique(base[:1600]), np.unique(base[400:])
    agree = (M.sketches([a])[0] == M.sketches([b])[0]).mean()
    assert abs(agree - 0.6) < 0.12
    one = M.sketches([a[:1], a[:0], a])
    assert (one[0] != M.EMPTY).all() and (one[1] == M.EMPTY).all() and (one[2] == M.sketches([a])[0]).all()


def test_sets_count_as_words_do():
    import pyarrow as pa

    rows = corpus(random.Random(8), 50)
    assert [len(s) for s in M.shingle_sets(*utf8(pa.array([t for _, t in rows])))] == [len(shingles(t)) for _, t in rows]


def test_words_that_polynomials_confuse(spark):
    """Words of 1024 letters whose polynomial hashes modulo 2**64 are equal for every odd base are not copies."""
    t = "a"
    for _ in range(10):
        t += t.translate(str.maketrans("ab", "ba"))
    other = t.translate(str.maketrans("ab", "ba"))
    rows = [(1, t), (2, other), (3, f"x {t} y z {t} w v"), (4, f"x {other} y z {other} w v"), (5, t.upper())]
    got = sorted(map(tuple, M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == brute(rows)


def test_links_are_confirmed_on_bytes(monkeypatch):
    """With one hash for all words, only texts with equal words are linked."""
    import pyarrow as pa

    monkeypatch.setattr(M, "run_hashes", lambda codes, first, last: np.ones(len(first), np.uint64))
    texts = ["a b c d e", "a b  c\td E", "a b c d x", "a b", "A b", "b a", "a b c"]
    s = list(M.shingled(*utf8(pa.array(texts))))
    same = {(i, j) for i in range(7) for j in range(i) if M.similar(s[i], s[j])}
    assert same == {(1, 0), (4, 3)}


def test_hub_and_large_component(spark, monkeypatch):
    """One node with half of all links; and a bucket whose largest component meets the rest alone."""
    links = spark.createDataFrame([(0, i) for i in range(1, 300)] + [(1000 + i, 1001 + i) for i in range(0, 300, 2)], "p long, v long")
    got = {r.v: r.c for r in M.components(links).collect()}
    assert {got[i] for i in range(300)} == {0} and all(got[1001 + i] == 1000 + i for i in range(0, 300, 2))
    rows = [(7, v, 0 if v < 90 else v, v) for v in range(100)] + [(8, v, 0, v) for v in range(5)]
    placed = spark.createDataFrame(rows, "key long, v long, c long, x long")
    blocks = M.block_counts(placed, "key", "b", M.F.count(M.F.lit(1)) / 8)
    assert [tuple(r) for r in blocks.collect()] == [(7, 0, 12, 2)]
    dealt = M.in_blocks(placed.join(blocks, "key"), "key", ["v", "c"]).collect()
    met = {}
    for r in dealt:
        met.setdefault((r.i, r.j), []).append((r.side, r.v, r.c))
    seen = set()
    for group in met.values():
        for x in group:
            for y in group:
                if x[1] < y[1] and x[2] != y[2] and (x[0] != y[0] or len({g[0] for g in group}) == 1):
                    seen.add((x[1], y[1]))
    assert seen == {(v, w) for w in range(90, 100) for v in range(w)}
    assert sum(r.v < 90 for r in dealt) == 2 * 90


def test_half_of_all_documents_are_equal(spark, monkeypatch):
    """Groups joined on their own: half of the rows one text, others in one bucket and one component."""
    from episodeframes.llm import common as C

    monkeypatch.setattr(C, "LIGHT", 2)
    monkeypatch.setattr(C, "HEAVY", 1 / 50)
    rnd = random.Random(21)
    rows = corpus(rnd, 80)
    base = [f"w{i}" for i in range(60)]
    for _ in range(30):
        words = list(base)
        words[rnd.randrange(60)] = f"x{rnd.randrange(10**6)}"
        rows.append((len(rows), " ".join(words)))
    rows += [(len(rows) + i, "one text that half of all documents have word for word") for i in range(110)] + [(900, None), (901, " ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, M.near_duplicates(df).collect())) == brute(rows)


def test_kept_rows_by_either_join(spark, monkeypatch):
    """Repeated rows, texts without words and near copies, with the odd keys broadcast and shuffled."""
    rows = corpus(random.Random(31), 60) + [(900, None), (900, None), (901, " "), (3, "twice the same row here"), (3, "twice the same row here")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, k1 string").repartition(4)
    want = sorted([r[0] for r in set(brute(rows)) if r[3] and r[0] not in (900, 901)] + [900, 900, 901])
    for most in (1_000_000, 0):
        monkeypatch.setattr(M, "MOST_ODD", most)
        left = M.drop_near_copies(df)
        assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == want
