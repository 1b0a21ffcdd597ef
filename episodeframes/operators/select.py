"""Choosing, trimming and renaming."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import doubles, frame_time
from ..schema import ACTION, STATE, Dataset, DatasetInfo, col_
from ..sources.datasets import kept
from .reindex import length_prefix, reindex
from .tasks import remap_tasks


def parse_episode_selector(text: str, total: int, strict: bool = False) -> list[int]:
    """B1: "1,3,5-7" (ranges inclusive), a JSON list, or a JSON object of lists; other tokens are ignored. Numbers out of
    range are ignored, or an error if ``strict``."""
    try:
        raw = json.loads(text)
    except ValueError:
        raw = None
    if isinstance(raw, dict):
        raw = [x for v in raw.values() for x in (v if isinstance(v, list) else [v])]
    if isinstance(raw, list):
        found = {int(x) for x in raw if isinstance(x, int) and not isinstance(x, bool)}
    else:
        found = set()
        for token in re.split(r"[,\s]+", text):
            if m := re.fullmatch(r"(\d+)(?:-(\d+))?", token):
                found.update(range(int(m[1]), int(m[2] or m[1]) + 1))
    if strict and any(not 0 <= x < total for x in found):
        raise ValueError(f"episodes out of 0 to {total - 1}: {sorted(x for x in found if not 0 <= x < total)}")
    return sorted(x for x in found if 0 <= x < total)


def _ids(ds: Dataset, ids) -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids.select(F.col("episode_index").cast("long").alias("episode_index"))
    return ds.frames.sparkSession.createDataFrame([(int(i),) for i in ids], "episode_index long")


def _semi(ds: Dataset, ids: DataFrame, how: str = "left_semi") -> Dataset:
    return ds.with_(
        frames=ds.frames.join(ids, "episode_index", how), episodes=ds.episodes.join(ids, "episode_index", how),
        stats=ds.stats and ds.stats.join(ids, "episode_index", how)
    )


def select_episodes(ds: Dataset, ids, task_map: Mapping[int, str] | None = None, renumber: bool = True) -> Dataset:
    """The chosen episodes (a list or a table of episode_index), renumbered; tasks in use stay. ``task_map`` appends a
    task name to an episode (metadata only)."""
    out = _semi(ds, _ids(ds, ids))
    if task_map:
        named = ds.frames.sparkSession.createDataFrame([(int(k), v) for k, v in task_map.items()], "episode_index long, _task string")
        episodes = out.episodes.join(named, "episode_index", "left")
        out = out.with_(
            episodes=episodes.withColumn(
                "tasks", F.when(F.col("_task").isNull(), F.col("tasks")).otherwise(F.array_union("tasks", F.array("_task")))
            ).drop("_task")
        )
    return reindex(remap_tasks(out, "used")) if renumber else out


def remove_episodes(ds: Dataset, ids, renumber: bool = True) -> Dataset:
    """B2: all but the given episodes."""
    out = _semi(ds, _ids(ds, ids), "left_anti")
    return reindex(remap_tasks(out, "used")) if renumber else out


def remove_short_episodes(ds: Dataset, min_length: int) -> Dataset:
    """Episodes of fewer than min_length frames go."""
    return remove_episodes(ds, ds.episodes.filter(F.col("length") < min_length))


def extract_episode_range(ds: Dataset, start: int, end: int, total: int | None = None) -> Dataset:
    """Episodes start to end, both inclusive; frame_index and timestamp stay."""
    total = ds.episodes.count() if total is None else total
    if not 0 <= start <= end < total:
        raise ValueError(f"a range within 0 to {total - 1}")
    between = F.col("episode_index").between(start, end)
    out = ds.with_(frames=ds.frames.filter(between), episodes=ds.episodes.filter(between), stats=ds.stats and ds.stats.filter(between))
    return reindex(remap_tasks(out, "strict"), reset_frame_index=False)


def label_terminated(episodes: DataFrame, start: int, field: str = "terminated", overwrite: bool = False) -> DataFrame:
    """A boolean field, true from episode ``start`` on."""
    if field in ("episode_index", "tasks", "length"):
        raise ValueError(f"{field} can't be a label")
    if field in episodes.columns and not overwrite:
        raise ValueError(f"{field} exists")
    return episodes.withColumn(field, F.col("episode_index") >= start)


def rename_features(ds: Dataset, names: Mapping[str, str]) -> Dataset:
    """Features renamed in frames, declarations and statistics; a name that is taken is an error."""
    after = [names.get(c, c) for c in ds.frames.columns]
    declared = [names.get(k, k) for k in ds.info.features]
    if len(set(after)) < len(after) or len(set(declared)) < len(declared):
        raise ValueError("two features of one name")
    return ds.with_(
        frames=ds.frames.toDF(*after), info=replace(ds.info, features=dict(zip(declared, ds.info.features.values(), strict=True))),
        stats=rename_stats(ds.stats, names)
    )


def rename_stats(stats: DataFrame | None, names: Mapping[str, str]) -> DataFrame | None:
    if stats is None or not names:
        return stats
    table = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
    return stats.withColumn("stats", F.transform_keys("stats", lambda k, _: F.coalesce(table[k], k)))


def trim_frames(
    ds: Dataset, head: int = 0, tail: int = 0, head_s: float | None = None, tail_s: float | None = None, on_short: str = "error",
    whole: int | None = None, renumber: bool = True
) -> Dataset:
    """Frames off the head and tail (seconds override, rounded half to even). An episode without rest is an error, or is
    dropped; survivors are renumbered (where ``renumber``) and their times rebuilt.

    Where episodes are recorded over ``whole`` frames, head and tail are frame numbers of a whole episode: one that was cut
    short, or lacks frames, loses only those that it has of them."""
    head = round(head_s * ds.info.fps) if head_s is not None else head
    tail = round(tail_s * ds.info.fps) if tail_s is not None else tail
    if whole is not None:
        return reindex(_trim_whole(ds, head, whole - tail, on_short), reset_timestamp="rounded", renumber=renumber)
    n, place = F.count(F.lit(1)).over(Window.partitionBy("episode_index")), F.row_number().over(
        Window.partitionBy("episode_index").orderBy("frame_index")
    ) - 1
    df = ds.frames.withColumn("_n", n).withColumn("_place", place)
    if on_short == "error":
        df = df.filter(F.assert_true(F.col("_n") > head + tail, F.lit("an episode is not longer than what is trimmed")).isNull())
    df = df.filter((F.col("_place") >= head) & (F.col("_place") < F.col("_n") - tail)).drop("_n", "_place")
    episodes = ds.episodes.withColumn("length", F.col("length") - head - tail).filter("length > 0")
    return reindex(ds.with_(frames=df, episodes=episodes, stats=None), reset_timestamp="rounded", renumber=renumber)


def _trim_whole(ds: Dataset, start: int, end: int, on_short: str) -> Dataset:
    """Frames start to end - 1 of each episode, and its length counted from them."""
    inside = F.col("frame_index").between(start, end - 1)
    left = ds.frames.groupBy("episode_index").agg(F.count_if(inside).alias("_left"))
    if on_short == "error":
        left = left.filter(F.assert_true(F.col("_left") > 0, F.lit("an episode has only frames that are trimmed")).isNull())
    episodes = ds.episodes.join(left, "episode_index").withColumn("length", F.col("_left")).drop("_left").filter("length > 0")
    return ds.with_(frames=ds.frames.filter(inside), episodes=episodes, stats=None)


def decimate(ds: Dataset, factor: int) -> Dataset:
    """Frames 0, N, 2N, ...; times i * float32(1 / fps), not rounded; fps stays."""
    if factor < 1:
        raise ValueError("a factor of 1 or more")
    frames = ds.frames.filter(F.col("frame_index") % factor == 0).withColumn("frame_index", F.floor(F.col("frame_index") / factor))
    frames = frames.withColumn("timestamp", frame_time(F.col("frame_index"), ds.info.fps, "float32"))
    episodes = ds.episodes.withColumn("length", F.ceil(F.col("length") / factor))
    return reindex(ds.with_(frames=frames, episodes=episodes, stats=None), reset_frame_index=False)


def decimate_split(ds: Dataset, ratio: float, factor: int, total: int | None = None) -> Dataset:
    """The first max(1, int(n * ratio)) episodes decimated, then the others unchanged, renumbered in that order."""
    if not 0 < ratio < 1:
        raise ValueError("a ratio between 0 and 1")
    if factor < 1:
        raise ValueError("a factor of 1 or more")
    total = ds.episodes.count() if total is None else total
    numbered = length_prefix(ds.episodes.select("episode_index", "length"))
    thin = F.col("new_episode") < max(1, int(total * ratio))
    # the new lengths are in the order of the old numbers, so their sums give every frame's place in one pass over frames
    lengths = numbered.select(
        "episode_index", thin.alias("_thin"), F.when(thin, F.ceil(F.col("length") / factor)).otherwise(F.col("length")).alias("length")
    )
    places = length_prefix(lengths, carry=["_thin"])
    frames = ds.frames.join(places.drop("length"), "episode_index").filter(~F.col("_thin") | (F.col("frame_index") % factor == 0))
    frame = F.when(F.col("_thin"), F.floor(F.col("frame_index") / factor)).otherwise(F.col("frame_index"))
    frames = frames.withColumn("frame_index", frame.cast("long")).withColumn(
        "index", F.col("first_index") + F.col("frame_index")
    ).withColumn("episode_index", F.col("new_episode"))
    frames = frames.withColumn(
        "timestamp",
        F.when(
            F.col("_thin"), frame_time(F.col("frame_index"), ds.info.fps, "float32")
        ).otherwise(F.col("timestamp") if "timestamp" in frames.columns else F.lit(None))
    )
    numbers = places.select("episode_index", "new_episode", F.col("length").alias("_length"))
    episodes = ds.episodes.join(numbers, "episode_index").withColumn(
        "episode_index", F.col("new_episode")
    ).withColumn("length", F.col("_length")).drop("new_episode", "_length")
    return ds.with_(frames=frames.drop("_thin", "first_index", "new_episode"), episodes=episodes, stats=None)


def head_episodes(ds: Dataset, n: int) -> Dataset:
    """The n episodes of the smallest numbers."""
    return _semi(ds, ds.episodes.select("episode_index").orderBy("episode_index").limit(n))


def drop_features(ds: Dataset, keys: Sequence[str]) -> Dataset:
    """Columns and declarations of the features go."""
    kept = [c for c in ds.frames.columns if c not in keys]
    return ds.with_(
        frames=ds.frames.select(*(col_(c) for c in kept)),
        info=replace(ds.info, features={k: v for k, v in ds.info.features.items() if k not in keys})
    )


def even_indices(n: int, k: int, truncate: bool = False) -> list[int]:
    """k places spread over n, ends included: rounded half to even, or truncated; doubles fall together."""
    if k < 1 or n < 1:
        return []
    if k == 1:
        return [0]
    step = (n - 1) / (k - 1)
    return sorted({int(i * step) if truncate else round(i * step) for i in range(k)})


def evenly_sample(
    df: DataFrame, k: int, order_by: Sequence[str], partition_by: Sequence[str] = ("episode_index",), truncate: bool = False
) -> DataFrame:
    """K rows spread evenly over each group (over the whole table where ``partition_by`` is empty).

    Place p is chosen if some i below k has round(i * step) = p, half to even (or truncated). Such an i can only lie next to
    p / step, so three candidates are tried for each row, whatever k is.
    """
    if partition_by:
        w = Window.partitionBy(*partition_by)
        df = df.withColumn("_n", F.count(F.lit(1)).over(w)).withColumn("_place", F.row_number().over(w.orderBy(*order_by)) - 1)
    else:
        df = placed(df, order_by)
    step, place = (F.col("_n") - 1) / F.lit(max(1, k - 1)), F.col("_place")
    near = F.when(step > 0, (F.ceil(place / step) if truncate else F.round(place / step))).otherwise(0).cast("long")
    hit = F.lit(False)
    for i in (near - 1, near, near + 1):
        at = F.floor(i * step) if truncate else F.bround(i * step).cast("long")
        hit = hit | ((i >= 0) & (i < k) & (at == place))
    return df.filter(hit).drop("_n", "_place")


def placed(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """The rows with _place, their number in the order of the whole table, and _n, the number of all.

    Sampled splitters range the rows into sorted parts, written once; a row for each part carries the rows before it.
    """
    local = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn("_id", F.monotonically_increasing_id())
    local = kept(local, "ordered").withColumn("_part", F.shiftright("_id", 33))
    sums = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"), F.sum("_rows").over(Window.partitionBy()).alias("_n"))
    rows = local.join(F.broadcast(bases), "_part")  # a row for each task
    return rows.withColumn("_place", F.col("_base") + F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id", "_part", "_base")


def align_to(ds: Dataset, reference: DatasetInfo, key_map: Mapping[str, str], task_prompt: str) -> Dataset:
    """Camera keys renamed, robot type and feature declarations of the reference, one task for all; frames unchanged."""
    features = {key_map.get(k, k): v for k, v in ds.info.features.items()}
    features = {
        k: {**v, **{x: reference.features[k][x] for x in ("names", "info") if x in reference.features.get(k, {})}} for k, v in features.items()
    }
    spark = ds.frames.sparkSession
    episodes = ds.episodes.withColumn("tasks", F.array(F.lit(task_prompt))).withColumn("task_index", F.lit(0).cast("long"))
    return ds.with_(
        info=replace(ds.info, robot_type=reference.robot_type, features=features), episodes=episodes,
        tasks=spark.createDataFrame([(0, task_prompt)], "task_index long, task string"), stats=rename_stats(ds.stats, key_map)
    )


def rounded(v: Column, decimals: int) -> Column:
    return F.transform(v, lambda x: F.bround(x, decimals))


def episode_view(ds: Dataset, episode_index: int, decimals: int = 2) -> DataFrame:
    """One episode in frame order, values rounded."""
    df = ds.frames.filter(F.col("episode_index") == episode_index).orderBy("frame_index")
    time = F.bround(F.col("timestamp").cast("double"), decimals).alias("timestamp")
    return df.select("episode_index", rounded(doubles(ACTION), decimals).alias(ACTION), rounded(doubles(STATE), decimals).alias(STATE), time)

