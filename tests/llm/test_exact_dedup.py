import hashlib
import random

import numpy as np
import pytest

from episodeframes.llm import exact_dedup as X

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault((t or "").translate(LOW), []).append(d)
    for d, t in rows:
        own = groups[(t or "").translate(LOW)]
        yield d, max(own), len(own), d == max(own), hashlib.sha256((t or "").translate(LOW).encode()).hexdigest()


def corpus():
    rnd = random.Random(1)
    some = ["", "a", "A", "É", "é", "x" * 70_000, "X" * 70_000, "x" * 69_999 + "y", "b" * 65_536, "b" * 65_537, " a", "\x00", "\x00\x00"]
    rows = [
        (i, rnd.choice([*some, None])) for i in range(300)
    ] + [(i, f"unique {i}") for i in range(300, 400)] + [(i, "hot Copy") for i in range(400, 700)]
    rnd.shuffle(rows)
    return rows


def test_against_brute_force(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "z", 0) for r in rows], "doc_id long, text string, kept string, fp int").repartition(4)
    assert sorted(map(tuple, X.exact_groups(df).collect())) == sorted(brute(rows))
    left = X.drop_exact_copies(df)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == sorted(d for d, _, _, kept, _ in brute(rows) if kept)


@pytest.mark.parametrize("collide", [lambda c: (1, 2), lambda c: (len(c) % 2, 0)])
def test_equal_fingerprints_of_different_texts(spark, monkeypatch, collide):
    """With a hash that collides, the chunkwise comparison finds it and groups are split."""
    monkeypatch.setattr(X, "chunk_values", collide)
    monkeypatch.setattr(X, "CHUNK", 8)
    monkeypatch.setattr(X, "combine", lambda a, b: (1, 2, a[2] + b[2]))
    found = X._fingerprints(0)
    import pyarrow as pa

    batch = next(iter(found(iter([pa.RecordBatch.from_arrays([pa.array(["abcdefghi", "abcdefghj"])], ["t"])]))))
    assert batch.column(1)[0] == batch.column(1)[1] and batch.column(3)[0] != batch.column(3)[1]
    rows = [(1, "abcdefghi"), (2, "abcdefghj"), (3, "ABCDEFGHI")]
    base = spark.createDataFrame(
        [(d, t, i, 7, 9, bytearray(hashlib.sha256(t.lower().encode()).digest())) for i, (d, t) in enumerate(rows)],
        "_0 long, _1 string, row long, fp long, n long, sha binary"
    )
    base = X.materialize(base, "colliding")
    got = {r._0: (r.keep_id, r.group_size) for r in X.classes(base, "_0", "_1").collect()}
    assert got == {1: (3, 2), 2: (2, 1), 3: (3, 2)}


def test_parts_combine_to_the_whole(spark):
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 200_000).astype(np.uint8)
    whole = X.fingerprint(data)
    for cut in (0, 1, 65_535, 65_536, 65_537, 199_999):
        assert X.combine(X.fingerprint(data[:cut]), X.fingerprint(data[cut:])) == whole
    text = "Some Text " * 20_000
    pieces = spark.createDataFrame(
        [(1, i // 30_000, text[i : i + 30_000]) for i in range(0, len(text), 30_000)] + [(2, 0, None)], "id long, no int, part string"
    )
    got = {r.doc_id: (r.fp, r.n) for r in X.pieces_fingerprint(pieces, "id", "no", "part").collect()}
    a, b, n = X.fingerprint(np.frombuffer(text.lower().encode(), np.uint8))
    assert got == {1: (a << 31 | b, n), 2: (0, 0)}


def test_huge_texts_are_hashed_in_pieces(spark, monkeypatch):
    """The pieces of a huge text meet as values only; nothing else about the result changes."""
    for name, value in (("HUGE", 30), ("PIECE", 16)):
        monkeypatch.setattr(X, name, value)
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("abÉ日 Z") for _ in range(n)) for n in (29, 30, 31, 32, 33, 64, 65, 400)]
    rows = [(i, t) for i, t in enumerate([*texts, *texts[3:], texts[5].replace("Z", "z"), texts[-1] + "x", None, ""])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, X.exact_groups(df).collect())) == sorted(brute(rows))
    assert X.drop_exact_copies(df).count() == sum(kept for _, _, _, kept, _ in brute(rows))
    huge = X.fingerprinted(df.toDF("_0", "_1"), "_1").filter("n > 30").select("_1", "fp", "n").collect()
    for text, fp, n in huge:
        a, b, size = X.fingerprint(np.frombuffer(text.encode().translate(X.LOWER), np.uint8))
        assert (fp, n) == (a << 31 | b, size)


def test_repeated_rows_null_ids_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, None), (None, "")], "doc_id long, text string")
    got = X.exact_groups(df).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size) for r in got) == [
        ("1", "1", 3), ("1", "1", 3), ("None", "1", 3), ("None", "None", 2), ("None", "None", 2)
    ]
    assert sum(r.kept for r in got) == 2 and X.drop_exact_copies(df).count() == 2
    assert X.exact_groups(df.limit(0)).collect() == []
