"""Merging datasets."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import MOST_SMALL, Dataset, col_
from .reindex import length_prefix


def check_mergeable(datasets: Sequence[Dataset]) -> None:
    if not datasets:
        raise ValueError("one dataset at least")
    first = datasets[0].info
    for k, d in enumerate(datasets[1:], 1):
        if d.info.codebase_version != "v2.1":
            raise ValueError(f"dataset {k} is of version {d.info.codebase_version}")
        if d.info.fps != first.fps:
            raise ValueError(f"dataset {k} has {d.info.fps} frames a second, not {first.fps}")
        if set(d.info.features) != set(first.features) or {*d.frames.columns, "index"} != {*datasets[0].frames.columns, "index"}:
            raise ValueError(f"dataset {k} has other features")


def copied(tasks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The numbered tasks and their distinct names. A small table is read to the driver once and broadcast from there."""
    rows = tasks.limit(MOST_SMALL + 1).collect()
    if len(rows) <= MOST_SMALL:
        tasks = F.broadcast(tasks.sparkSession.createDataFrame(rows, tasks.schema))
    return tasks, tasks.select("task", "new_task").distinct()


def merge_datasets(datasets: Sequence[Dataset]) -> Dataset:
    """Datasets one after the other: episodes numbered in the order (dataset, episode), tasks by the first appearance of their
    name, index over the whole; times and frame numbers stay. Frames move only in joins with the small number tables."""
    check_mergeable(datasets)

    def union(parts):
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out

    def numbered(part, k):
        return part.withColumn("_src", F.lit(k))

    fields = [f for f in datasets[0].frames.schema.fields if f.name != "index"]  # rebuilt below
    frames = union([numbered(d.frames.select(*(col_(f.name).cast(f.dataType).alias(f.name) for f in fields)), k) for k, d in enumerate(datasets)])
    episodes = union([numbered(d.episodes, k) for k, d in enumerate(datasets)])
    tasks = union([numbered(d.tasks, k) for k, d in enumerate(datasets)])

    # a key that sorts by (dataset, episode) for the prefix sums
    key = (F.col("_src").cast("long") * F.lit(1 << 40) + F.col("episode_index")).alias("_key")
    places = length_prefix(episodes.select(key, "length"), "_key").select("_key", "new_episode", "first_index")
    first = tasks.groupBy("task").agg(F.min(F.struct("_src", "task_index")).alias("_first"))
    names = first.withColumn("new_task", (F.row_number().over(Window.orderBy("_first", "task")) - 1).cast("long")).select("task", "new_task")
    # read once: the names serve the frames' numbers and the new tasks table
    tasks, names = copied(tasks.join(names, "task").select("_src", "task_index", "task", "new_task"))
    numbers = tasks.select("_src", "task_index", "new_task")

    frames = frames.withColumn("_key", key).join(places, "_key").join(numbers, ["_src", "task_index"], "left")
    frames = frames.withColumn("episode_index", F.col("new_episode")).withColumn(
        "index", F.col("first_index") + F.col("frame_index")
    ).withColumn("task_index", F.coalesce("new_task", "task_index"))
    episodes = episodes.withColumn("_key", key).join(places, "_key").withColumn(
        "episode_index", F.col("new_episode")
    ).select(datasets[0].episodes.columns)
    stats = None
    if all(d.stats is not None for d in datasets):
        stats = union(
            [numbered(d.stats, k) for k, d in enumerate(datasets)]
        ).withColumn("_key", key).join(places, "_key").select(F.col("new_episode").alias("episode_index"), "stats")
    columns = datasets[0].frames.columns
    return Dataset(
        frames.select(*(col_(c) for c in (columns if "index" in columns else [*columns, "index"]))), episodes,
        names.select(F.col("new_task").alias("task_index"), "task"), replace(datasets[0].info), stats
    )
