"""Statistics that must hold at any size: pooled moments, vectors of unlike widths, quantiles by ranks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodeframes.operators import quantiles, stats
from episodeframes.schema import STATE, col_


def frame(spark, rows):
    return spark.createDataFrame(rows, f"episode_index long, frame_index long, `{STATE}` array<float>")


def by_place(df):
    return {(r.episode_index, r.dim): r for r in stats.stats_rows(df).collect()}


def test_vectors_of_unlike_widths(spark):
    rows = [(0, 0, None), (0, 1, [1.0]), (0, 2, [1.0, 5.0]), (0, 3, [2.0, 7.0, None]), (1, 0, []), (1, 1, None), (2, 0, [3.0, float("nan")])]
    found = by_place(stats.episode_stats(frame(spark, rows), [STATE]))
    assert set(found) == {(0, 0), (0, 1), (0, 2), (2, 0), (2, 1)}
    a, b, c = found[0, 0], found[0, 1], found[0, 2]
    assert (a.n, a.min, a.max, a.mean) == (4, 1, 2, pytest.approx(4 / 3)) and (b.min, b.max, b.mean, b["std"]) == (5, 7, 6, 1)
    assert (c.min, c.max, c.mean, c["std"]) == (None, None, None, None) and np.isnan(found[2, 1].min)
    counts = {r.episode_index: r.n for r in stats.episode_stats(frame(spark, rows), [STATE]).select("episode_index", F.col("stats")[STATE]["count"][0].alias("n")).collect()}
    assert counts == {0: 4, 1: 2, 2: 1}
    with pytest.raises(Exception, match="not as wide as declared"):
        stats.episode_stats(frame(spark, rows), [STATE], {STATE: 2}).collect()


def test_pooled_deviation_does_not_cancel(spark):
    rng = np.random.default_rng(3)
    parts = [rng.normal(1e8, 0.5, n) for n in (1, 2, 50, 400)] + [np.array([1e8, 1e8 + 1])]
    f = spark.createDataFrame([(e, i, float(x), [float(x)]) for e, v in enumerate(parts) for i, x in enumerate(v)], "episode_index long, frame_index long, index double, v array<double>")
    out = {r.feature: r for r in stats.aggregate_stats(stats.episode_stats(f, ["index", "v"])).collect()}
    whole = np.concatenate(parts)
    for r in out.values():
        assert r["std"] == pytest.approx(whole.std(), rel=1e-6) and r["mean"] == pytest.approx(whole.mean(), rel=1e-14) and r.n == len(whole)
    two = stats.aggregate_stats(stats.episode_stats(f.filter("episode_index = 4"), ["v"])).first()
    assert two["std"] == pytest.approx(0.5)


def test_statistics_take_one_exchange_of_hashed_frames(spark):
    f = frame(spark, [(e, i, [1.0, 2.0]) for e in range(4) for i in range(3)]).repartition(4, "episode_index")
    plan = stats.episode_stats(f, [STATE])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("few", [True, False])
def test_bracketed_quantiles(spark, monkeypatch, few):
    """Groups above the buffer: small cells, heavy values, infinite ones and NaN, and sketches that err."""
    monkeypatch.setattr(quantiles, "BUFFERED", 0)
    monkeypatch.setattr(quantiles, "CELL_ROWS", 3)
    rng = np.random.default_rng(5)
    groups = {
        "normal": rng.normal(size=4000), "heavy": np.array([1.0] * 900 + [2.0] * 50 + [3.0]), "wide": 10.0 ** rng.uniform(-300, 300, 700), "one": np.array([7.0]),
        "two": np.array([3.0, 1.0]), "ends": np.array([-np.inf] * 3 + [0.0, 1.0, 2.0, 5.0] + [np.inf] * 2),
    }
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.95, 0.999, 1.0]
    df = spark.createDataFrame([(g, float(x)) for g, v in groups.items() for x in v] + [("none", None), (None, 1.0)], "g string, x double").repartition(5)
    for accuracy in (10_000, 5):
        monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
        got = {r.g: r.q for r in quantiles.exact_quantiles(df, ["g"], "x", probabilities, few).collect()}
        assert set(got) == set(groups)
        for g, v in groups.items():
            v, at = np.sort(v), [p * (len(v) - 1) for p in probabilities]
            low, high = v[np.floor(at).astype(int)], v[np.ceil(at).astype(int)]
            with np.errstate(invalid="ignore"):
                share = np.array(at) - np.floor(at)
                want = np.where((low == high) | (share == 0), low, (1 - share) * low + share * high)
            assert got[g] == pytest.approx(want, rel=1e-9, nan_ok=True), g
    assert quantiles.exact_quantiles(df.filter("g = 'heavy'"), [], "x", [0.5, 1.0], few).first().q == [1.0, 3.0]


def test_only_brackets_of_wanted_ranks_are_ordered(spark, monkeypatch):
    """A hundredth of the rows at most are counted by value for two probabilities, and a cell of them is sorted."""
    monkeypatch.setattr(quantiles, "BUFFERED", 0)
    monkeypatch.setattr(quantiles, "CELL_ROWS", 100)
    df = spark.range(200_000).select(F.lit(0).alias("g"), (F.col("id") * 7919 % 200_003).cast("double").alias("x"))
    out = quantiles.exact_quantiles(df, ["g"], "x", [0.5, 0.99])
    v = np.sort(np.arange(200_000) * 7919 % 200_003)
    assert out.first().q == pytest.approx(np.quantile(v, [0.5, 0.99]))
    out.collect()
    tops = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name == "Window" and "_x#" in node.toString().split("\n")[0]:
            tops.append(rows_below(node.children().apply(0)))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    def rows_below(node):
        """Rows out of the nearest node below that counts them."""
        if "QueryStage" in node.nodeName():
            return rows_below(node.plan())
        if node.metrics().contains("numOutputRows"):
            return node.metrics().apply("numOutputRows").value()
        return rows_below(node.children().apply(0))

    walk(out._jdf.queryExecution().executedPlan())
    assert tops and max(tops) <= 4 * 100
