"""Statistics of features."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import Dataset, DatasetInfo, chunks_of, col_
from .moments import pooled, state


def _nan_aware(agg: Column, x: Column) -> Column:
    """As numpy: a NaN makes a minimum NaN (Spark skips it)."""
    return F.when(F.bool_or(F.isnan(x)), F.lit(float("nan"))).otherwise(agg)


def vector_of(frames: DataFrame, feature: str) -> Column:
    """A feature as a vector of doubles; a scalar is a vector of one."""
    x = col_(feature)
    return x.cast("array<double>") if isinstance(frames.schema[feature].dataType, T.ArrayType) else F.array(x.cast("double"))


def episode_stats(
    frames: DataFrame, features: list[str], widths: Mapping[str, int | None] | None = None, previous: DataFrame | None = None
) -> DataFrame:
    """episode_index, stats (map by feature of min, max, mean, population std and count). Visual statistics of
    ``previous`` are carried over.

    No width is looked up: each number goes to the state of its place in its episode, so vectors of unlike widths, and null
    ones, give statistics for every place that any frame of the episode has (of the frames that have it); count is the
    number of frames. Where ``widths`` declares one, another is an error. Map-side sums leave a row for each episode and
    place; frames that are hashed by episode already don't move again.
    """
    vectors = []
    for k, f in enumerate(features):
        v, wide = vector_of(frames, f), (widths or {}).get(f)
        if wide is not None:
            same = F.assert_true(v.isNull() | (F.size(v) == wide), F.lit(f"a vector of {f} is not as wide as declared ({wide})"))
            v = F.when(same.isNull(), v)
        vectors.append(F.struct(F.lit(k).alias("k"), v.alias("v")))
    each = frames.select("episode_index", F.explode(F.array(*vectors)).alias("f")).select(
        "episode_index", "f.k", F.posexplode_outer("f.v").alias("dim", "x")
    )
    x = F.col("x")
    places = each.groupBy("episode_index", "k", "dim").agg(
        F.count(F.lit(1)).alias("n"), _nan_aware(F.min(x), x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")
    )
    # each frame has one row at place 0 of the first feature, or one without a place
    count = F.sum(F.when((F.col("k") == 0) & (F.coalesce("dim", F.lit(0)) == 0), F.col("n"))).alias("_n")
    lists = [
        F.sort_array(F.collect_list(F.when((F.col("k") == k) & F.col("dim").isNotNull(), F.struct("dim", "min", "max", "mean", "std")))).alias(f"_{k}")
        for k in range(len(features))
    ]
    maps = []
    for k, f in enumerate(features):
        maps += [F.lit(f), F.struct(*(F.col(f"_{k}.{m}").alias(m) for m in ("min", "max", "mean", "std")), F.array("_n").alias("count"))]
    df = places.groupBy("episode_index").agg(count, *lists).select("episode_index", F.create_map(*maps).alias("stats"))
    if previous is None:
        return df
    old = previous.select("episode_index", F.map_filter("stats", lambda k, _: ~k.isin(features)).alias("_old"))
    return df.join(old, "episode_index", "left").select(
        "episode_index", F.when(F.col("_old").isNull(), F.col("stats")).otherwise(F.map_concat("_old", "stats")).alias("stats")
    )


def stats_rows(stats: DataFrame) -> DataFrame:
    """Statistics as rows: episode_index, feature, dim, min, max, mean, std, n."""
    flat = stats.select("episode_index", F.explode("stats").alias("feature", "s"))
    dims = flat.select(
        "episode_index", "feature", F.col("s.count")[0].alias("n"), F.posexplode(F.arrays_zip("s.min", "s.max", "s.mean", "s.std")).alias("dim", "z")
    )
    return dims.select("episode_index", "feature", "dim", "n", "z.min", "z.max", "z.mean", "z.std")


def aggregate_stats(stats: DataFrame) -> DataFrame:
    """(feature, dim) of the whole dataset from those of its episodes: count-weighted mean and pooled population std,
    sqrt(sum n (std^2 + (mean - whole mean)^2) / sum n), from states that are merged pairwise."""
    moments = state(F.col("n"), F.col("mean"), F.col("std"))
    ends = [F.min("min").alias("min"), F.max("max").alias("max"), F.sum("n").alias("n")]
    return pooled(stats_rows(stats), ["feature", "dim"], F.col("episode_index"), moments, ends, ends).select(
        "feature", "dim", "min", "max", "mean", "std", "n"
    )


def compare_stats(a: DataFrame, b: DataFrame, rtol: float = 1e-5, atol: float = 1e-8) -> DataFrame:
    """D3: (feature, dim, stat) where two dataset-level tables differ by more than atol + rtol * |b|, or only one has it."""

    def long(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            "feature", "dim",
            F.explode(F.create_map(*(x for m in ("min", "max", "mean", "std", "n") for x in (F.lit(m), F.col(m).cast("double"))))).alias("stat", name)
        )

    both = long(a, "a").join(long(b, "b"), ["feature", "dim", "stat"], "full")
    off = F.abs(F.col("a") - F.col("b")) > atol + rtol * F.abs("b")
    return both.filter(off | F.col("a").isNull() | F.col("b").isNull())


def rebuild_info(ds: Dataset) -> tuple[DatasetInfo, dict]:
    """Totals from the tables; (info, {field: (old, new)}) of what changed."""
    from dataclasses import asdict, replace

    row = ds.episodes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("frames")).first()
    info = replace(
        ds.info, total_episodes=row.n, total_frames=row.frames, total_tasks=ds.tasks.count(), total_chunks=chunks_of(row.n, ds.info.chunks_size),
        total_videos=row.n * len(ds.info.video_keys()), splits={"train": f"0:{row.n}"},
    )
    old, new = asdict(ds.info), asdict(info)
    return info, {k: (old[k], new[k]) for k in new if old[k] != new[k]}
