import numpy as np
import pytest

from episodeframes.llm import embedding_dedup as E

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0, "x", "y") for i, v in rows], SCHEMA)


def brute(rows):
    """(vec_id, n_links, component_id, kept) by all pairs."""
    n, x = len(rows), []
    for _, v in rows:
        good = v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and any(v)
        x.append(np.array(v, np.float32).astype(float) if good else None)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(i + 1, n):
            if x[i] is not None and x[j] is not None and len(x[i]) == len(x[j]):
                link[i, j] = link[j, i] = x[i] @ x[j] >= 0.9 * np.linalg.norm(x[i]) * np.linalg.norm(x[j])
    label = list(range(n))
    while True:
        new = [min([label[i], *(label[j] for j in np.flatnonzero(link[i]))]) for i in range(n)]
        if new == label:
            break
        label = new
    out = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((rows[i][0], int(link[i].sum()), least, rows[i][0] == least))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in E.near_vectors(df).collect()), key=str)


def cloud(rng, n, dims, spread):
    centre = rng.standard_normal(dims)
    return centre / np.linalg.norm(centre) + spread * rng.standard_normal((n, dims)) / dims**0.5


def test_against_all_pairs(spark):
    """Chains and clouds around the limit, copies, scaled vectors, and unlike lengths."""
    rng = np.random.default_rng(1)
    some = [*rng.standard_normal((60, 24)), *cloud(rng, 40, 24, 0.25), *cloud(rng, 40, 24, 0.42), *rng.standard_normal((20, 3))]
    some += [some[60] * 2, some[0], some[0], some[100]]
    rows = list(enumerate(some))
    rng.shuffle(rows := [(int(i) * 7 % 1009, v) for i, v in rows])
    assert got(frame(spark, rows).repartition(5)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0, 0]), (4, [1, None]), (5, [nan, 1]), (6, [inf, 0]), (7, [1, 0]), (8, [2, 0]), (9, [-1, 0]), (9, [-1, 0.1]),
        (None, [0, 1]), (None, [0, 3]), (None, None), (10, [1e-30, 1e-30]), (11, [1e30, 1e30]), (12, [1]), (13, [-0.0, 1]),
    ]
    assert got(frame(spark, rows)) == brute(rows)
    assert got(frame(spark, [])) == []


def test_large_groups_in_blocks(spark, monkeypatch):
    """A third of all vectors in one cloud and many copies, in small blocks and windows."""
    monkeypatch.setattr(E, "BLOCK", 8)
    monkeypatch.setattr(E, "PAIRS_AT_ONCE", 16)
    rng = np.random.default_rng(2)
    rows = list(enumerate([*rng.standard_normal((40, 16)), *cloud(rng, 40, 16, 0.15), *[np.ones(16)] * 40]))
    assert got(frame(spark, rows).repartition(6)) == brute(rows)


@pytest.mark.parametrize(("dims", "vectors"), [(8, 500), (64, 70_000), (200, 3000)])
def test_recall_at_the_limit(dims, vectors):
    """Pairs at the least cosine: shared lists and counts miss as rarely as stated."""
    plan = E.calibrated(dims, vectors)
    rng = np.random.default_rng(3)
    a = rng.standard_normal((4000, dims))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((4000, dims))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + (1 - 0.81) ** 0.5 * b / np.linalg.norm(b, axis=1, keepdims=True)
    (x, p), (y, q) = E.furthest(a, plan.groups), E.furthest(b, plan.groups)
    hit = E.collide(x, p, y, q)
    shared = ((x == y).reshape(-1, plan.lists, plan.depth).all(axis=2) & hit[:, :: plan.depth]).any(axis=1)
    assert (shared & (hit.sum(axis=1) >= plan.least)).mean() > 0.99
    # and unrelated ones hardly meet
    assert (E.list_keys(x, plan)[1:] == E.list_keys(x, plan)[:-1]).mean() < 3 / vectors
