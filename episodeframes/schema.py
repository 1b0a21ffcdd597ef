"""Types, names and the container of an episode dataset."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE, ACTION = "observation.state", "action"
#: Names under which a dataset may hold its state and action vectors, in order of preference.
STATE_KEYS = ("observation.state", "state")
ACTION_KEYS = ("action", "actions")
STAT = "struct<min:array<double>,max:array<double>,mean:array<double>,std:array<double>,count:array<bigint>>"
STATS = f"map<string,{STAT}>"
EPISODES_SCHEMA = "episode_index long, tasks array<string>, length long"
TASKS_SCHEMA = "task_index long, task string"
EPISODE_STATS_SCHEMA = f"episode_index long, stats {STATS}"


def col_(name: str) -> Column:
    """A column whose name may hold dots."""
    return F.col(f"`{name}`")


#: Rows up to which a table is broadcast or copied to the driver.
MOST_SMALL = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """A table that is small by nature (task names, edges of groups): broadcast if counting shows that it is small."""
    return F.broadcast(df) if df.limit(MOST_SMALL + 1).count() <= MOST_SMALL else df


@dataclass
class DatasetInfo:
    """What ``meta/info.json`` declares; totals are rebuilt, never trusted."""

    fps: float = 30.0
    codebase_version: str = "v2.1"
    robot_type: str | None = None
    chunks_size: int = 1000
    data_path: str = "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet"
    video_path: str = "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4"
    total_episodes: int = 0
    total_frames: int = 0
    total_tasks: int = 0
    total_videos: int = 0
    total_chunks: int = 0
    splits: dict = field(default_factory=dict)
    features: dict = field(default_factory=dict)

    def names(self, key: str) -> list[str]:
        """Dimension names of a feature: a flat list, or a list that holds one list."""
        found = (self.features.get(key) or {}).get("names") or []
        return list(found[0]) if len(found) == 1 and isinstance(found[0], (list, tuple)) else list(found)

    def video_keys(self) -> list[str]:
        return [k for k, v in self.features.items() if isinstance(v, dict) and v.get("dtype") == "video"]

    def numeric_keys(self) -> list[str]:
        return [k for k, v in self.features.items() if v.get("dtype") not in ("image", "video", "string")]


@dataclass
class Dataset:
    """Frames (one row a frame) and the metadata tables around them."""

    frames: DataFrame
    episodes: DataFrame
    tasks: DataFrame
    info: DatasetInfo = field(default_factory=DatasetInfo)
    stats: DataFrame | None = None

    def with_(self, **changes) -> Dataset:
        return replace(self, **changes)

    @classmethod
    def of_frames(cls, frames: DataFrame, tasks: DataFrame | None = None, info: DatasetInfo | None = None) -> Dataset:
        """Metadata derived from the frames; tasks get names if none are given."""
        if tasks is None:
            number = F.col("task_index").cast("long")
            tasks = frames.select(number.alias("task_index")).distinct().withColumn("task", F.concat(F.lit("task "), F.col("task_index")))
            names = F.transform(F.sort_array(F.collect_set(number)), lambda x: F.concat(F.lit("task "), x))
            return cls(
                frames, frames.groupBy("episode_index").agg(names.alias("tasks"), F.count(F.lit(1)).alias("length")), tasks, info or DatasetInfo()
            )
        named = frames.groupBy("episode_index", "task_index").agg(F.count(F.lit(1)).alias("n")).join(small(tasks), "task_index", "left")
        ordered = F.transform(F.sort_array(F.collect_list(F.when(F.col("task").isNotNull(), F.struct("task_index", "task")))), lambda x: x["task"])
        episodes = named.groupBy("episode_index").agg(ordered.alias("tasks"), F.sum("n").alias("length"))
        return cls(frames, episodes, tasks, info or DatasetInfo())


def dims_of(names: Sequence[str], wanted: Sequence[str]) -> list[int]:
    """Places of the wanted names; every one must be there once."""
    out = []
    for w in wanted:
        found = [i for i, n in enumerate(names) if n == w]
        if len(found) != 1:
            raise ValueError(f"{w!r} is named {len(found)} times")
        out += found
    return out


def resolve_key(columns: Sequence[str], explicit: str | None, candidates: Sequence[str], on_ambiguous: str = "first") -> str:
    """An explicit key wins; else the first candidate present, or an error if several are and ``on_ambiguous`` says so."""
    if explicit is not None:
        if explicit not in columns:
            raise ValueError(f"no column {explicit!r}")
        return explicit
    found = [c for c in candidates if c in columns]
    if not found:
        raise ValueError(f"none of {list(candidates)}")
    if len(found) > 1 and on_ambiguous == "error":
        raise ValueError(f"more than one of {list(candidates)}: name it")
    return found[0]


def chunks_of(episodes: int, chunks_size: int) -> int:
    return math.ceil(episodes / chunks_size) if episodes else 0
