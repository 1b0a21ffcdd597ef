import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from episodeframes.llm import lexical_search as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(docs, items, top=50):
    found = [(i, terms(t)) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, length = len(found), sum(sum(c.values()) for _, c in found)
    df, out = Counter(t for _, c in found for t in c), []
    for item, text in dict.fromkeys(items):
        scores = []
        for i, c in found:
            m = 100 - 50 + 50 * sum(c.values()) * n_docs // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in terms(text) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0))
        out += [(item, k + 1, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def got(spark, docs, items, parts=3, **more):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, term string, rank int").repartition(parts)
    q = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, q string, score int")
    return sorted((tuple(r) for r in L.search(d, q, **more).collect()), key=str)


def corpus(n, seed=1):
    rnd = random.Random(seed)
    words = [f"{rnd.choice('abcdeéß日')}{k}" for k in range(300)]
    return [(i * 3, " ".join(rnd.choice(words[: rnd.choice((5, 50, 300))]) for _ in range(rnd.randrange(1, 60)))) for i in range(n)]


def test_against_all_scores(spark, monkeypatch):
    docs = corpus(700)
    items = [(k, docs[k][1]) for k in range(12)] + [(90, "a0 A0 b1, unknown_word"), (91, "nothing-known"), (92, "a0")]
    want = brute(docs, items)
    assert got(spark, docs, items) == want
    monkeypatch.setattr(L, "GRID_BYTES", 2000)
    monkeypatch.setattr(L, "PATHS_A_STEP", 64)
    monkeypatch.setattr(L, "ITEMS_AT_ONCE", 4)
    monkeypatch.setattr(L, "COUNTED_TERMS", 20)
    assert got(spark, docs, items, parts=7) == want
    assert got(spark, docs, items, top=3) == brute(docs, items, 3)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "!? -"), (4, "one two"), (None, "one two"), (None, "one two"), (5, "One\x00TWO two"), (5, "one"), (6, "É é E e"), ((1 << 63) - 1, "one two"), (-(1 << 63), "one two")]
    items = [(1, "one TWO"), (1, "one TWO"), (1, "two"), (2, None), (3, ""), (None, "é"), (4, "e")]
    assert got(spark, docs, items) == brute(docs, items)
    assert got(spark, [], items) == [] and got(spark, docs, []) == [] and got(spark, [(1, None)], items) == []


def test_many_equal_documents(spark):
    """A third of all rows is one text, with ties over several tasks."""
    docs = corpus(200) + [(10_000 + k, "a0 b1 b1 same text") for k in range(100)]
    assert got(spark, docs, items := [(1, "same text b1"), (2, "a0")], parts=9) == brute(docs, items)


def test_long_text_in_pieces(monkeypatch):
    rnd = random.Random(2)
    text = " ".join(rnd.choice(["Alpha", "be-ta", "γδ", "x" * 50]) for _ in range(3000))
    want = {t.encode(): n for t, n in terms(text).items()}
    for size in (1, 7, 100, 1 << 20):
        monkeypatch.setattr(L, "PIECE_BYTES", size)
        assert L.counted(text.encode()) == want


@pytest.mark.parametrize("shape", [(1, 1), (2, 5), (40, 7), (5, 300)])
def test_treap_holds_every_maximum(shape):
    rng = np.random.default_rng(4)
    cells = np.argwhere(rng.random(shape) < 0.3)
    cells = cells if len(cells) else np.array([[0, 0]])
    value = rng.integers(1, 1000, len(cells))
    tree = L.Treap.of({bytes([k, k // 256]): k for k in range(shape[0])}, cells[:, 0], cells[:, 1], value, shape[1])
    level = {(0, 0): 0}
    for depth in range(tree.height + 1):
        shift = tree.height - depth
        want = {}
        for (r, c), v in zip(cells.tolist(), value.tolist(), strict=True):
            want[r >> shift, c >> shift] = max(v, want.get((r >> shift, c >> shift), 0))
        assert {k: int(tree.largest[n]) for k, n in level.items()} == want
        if depth < tree.height:
            level = {
                (r * 2 + a, c * 2 + b): int(tree.child[n * 4 + a * 2 + b]) for (r, c), n in level.items() for a in (0, 1) for b in (0, 1) if tree.quarters[n * 4 + a * 2 + b]
            }
