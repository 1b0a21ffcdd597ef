import zlib
from collections import Counter

import numpy as np
import pytest

from episodeframes.llm import sharding as S


def test_matrix_sums():
    rows, sizes = [5, 0, 17, 1, 100], [41, 41, 41]
    m = S.communication_matrix(np.random.default_rng(1), rows, sizes)
    assert m.sum(1).tolist() == rows and m.sum(0).tolist() == sizes


def test_inversion_has_the_law(monkeypatch):
    monkeypatch.setattr(S, "NUMPY_MOST", 0)
    rng = np.random.default_rng(2)
    own = np.array([S.draw(rng, 30, 70, 20) for _ in range(20000)])
    lib = np.random.default_rng(3).hypergeometric(30, 70, 20, 20000)
    assert abs(own.mean() - lib.mean()) < 0.05 and abs(own.std() - lib.std()) < 0.05
    assert own.min() >= 0 and own.max() <= 20


def test_query(spark):
    docs = [(i, None if i % 7 == 0 else "x" * (i % 5) + "é") for i in range(1003)] + [(5, "again"), (5, "again"), (None, "null")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, shard int").repartition(5)
    df.write.parquet(p := S.materialize.__globals__["scratch_path"](spark, "in"))
    got = S.shards_query(spark, spark.read.parquet(p)).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs
    )
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(n))
    again = S.shards_query(spark, spark.read.parquet(p)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_uniform(spark):
    df = spark.range(0, 4000, 1, 4)
    place = {r.id: (r.shard, r.slot) for r in S.shuffle_into_shards(df, 4, seed=5).collect()}
    near = sum(place[i][0] == place[i + 1][0] for i in range(3999))
    assert 850 < near < 1150  # a quarter of neighbours share a shard
    assert abs(np.mean([place[i][1] for i in range(1000)]) - 499.5) < 45


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    got = S.shuffle_into_shards(spark.range(n), 8).collect()
    assert len(got) == n and all(r.slot == 0 for r in got)


def test_very_long_text(spark):
    rows = [(1, "é" * 3_000_000), (2, None), (3, ""), (4, "x")]
    got = {r.doc_id: r for r in S.shards_query(spark, spark.createDataFrame(rows, "doc_id long, text string"), shards=3).collect()}
    assert {d: (r.size, r.text_crc32) for d, r in got.items()} == {d: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in rows}
