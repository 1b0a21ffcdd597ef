"""Task numbers and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import Dataset, col_, small

DEFAULT_TASK, UNKNOWN_TASK = "default task", "unknown task"


def _dense(tasks: DataFrame, order: list) -> DataFrame:
    """(task_index, task, new_task): numbers by first appearance of a name; the tasks table is small by nature."""
    named = tasks.groupBy("task").agg(F.min(F.struct(*order)).alias("_first"))
    numbered = named.withColumn("new_task", (F.row_number().over(Window.orderBy("_first", "task")) - 1).cast("long"))
    return tasks.join(numbered.select("task", "new_task"), "task")


def remap_tasks(ds: Dataset, policy: str = "used") -> Dataset:
    """Dense numbers by name. ``used`` keeps tasks that frames or episodes use, in the order of the old numbers;
    ``strict`` is the same but a frame of an unknown task is an error; ``all`` keeps every task. Unknown numbers stay."""
    tasks = ds.tasks
    if policy != "all":
        by_frames = ds.frames.select("task_index").distinct()
        by_name = ds.episodes.select(F.explode("tasks").alias("task")).distinct()
        frames_use = tasks.join(by_frames, "task_index", "left_semi").select("task_index", "task")
        names_use = tasks.join(by_name, "task", "left_semi").select("task_index", "task")
        new = by_name.join(tasks, "task", "left_anti").select(F.lit(None).cast("long").alias("task_index"), "task")
        tasks = frames_use.unionByName(names_use).distinct().unionByName(new)
    order = [F.col("task_index").isNull().alias("none"), "task_index"]
    numbered = _dense(tasks, order)
    numbers = numbered.filter("task_index is not null").select("task_index", "new_task")
    frames = ds.frames.join(small(numbers), "task_index", "left") if policy != "strict" else ds.frames.join(numbers, "task_index", "left")
    if policy == "strict":
        frames = frames.filter(F.assert_true(F.col("new_task").isNotNull(), F.lit("a frame of a task that the table lacks")).isNull())
    frames = frames.withColumn("task_index", F.coalesce("new_task", "task_index")).drop("new_task").select(*map(col_, ds.frames.columns))
    return ds.with_(frames=frames, tasks=numbered.select(F.col("new_task").alias("task_index"), "task").distinct())


def used_tasks(ds: Dataset, summary: DataFrame | None = None) -> DataFrame:
    """(task_index, frames, episodes), episodes first: so their number is a sum. ``summary`` has (episode_index, task_index, rows)."""
    if summary is None:
        summary = ds.frames.groupBy("episode_index", "task_index").agg(F.count(F.lit(1)).alias("rows"))
    return summary.groupBy("task_index").agg(F.sum("rows").alias("frames"), F.count("episode_index").alias("episodes"))


def task_reference_report(ds: Dataset, summary: DataFrame | None = None) -> DataFrame:
    """(kind, task_index, episodes): numbers that frames use and the table lacks, and the reverse."""
    used = used_tasks(ds, summary).drop("frames")
    missing = used.join(ds.tasks, "task_index", "left_anti").select(F.lit("missing").alias("kind"), "task_index", "episodes")
    extra = ds.tasks.join(used, "task_index", "left_anti").select(F.lit("extra").alias("kind"), "task_index", F.lit(0).cast("long").alias("episodes"))
    return missing.unionByName(extra)


def unify_tasks(ds: Dataset) -> Dataset:
    """One task 0 for all, under the description of task 0, else of the first task, else a default."""
    best = ds.tasks.orderBy(F.col("task_index") != 0, "task_index").limit(1).agg(F.coalesce(F.first("task"), F.lit(DEFAULT_TASK)).alias("task"))
    tasks = best.select(F.lit(0).cast("long").alias("task_index"), "task")
    episodes = ds.episodes.crossJoin(F.broadcast(best)).withColumn("tasks", F.array("task")).drop("task")
    return ds.with_(frames=ds.frames.withColumn("task_index", F.lit(0).cast("long")), episodes=episodes, tasks=tasks)


def fill_missing_tasks(ds: Dataset, default: str = UNKNOWN_TASK) -> Dataset:
    """A description for every number that frames use and the table lacks; frames stay."""
    missing = ds.frames.select("task_index").distinct().join(ds.tasks, "task_index", "left_anti")
    return ds.with_(tasks=ds.tasks.unionByName(missing.select("task_index", F.concat(F.lit(default + " "), F.col("task_index")).alias("task"))))


def task_usage(ds: Dataset, file: str | None = None, summary: DataFrame | None = None) -> DataFrame:
    """Frames, share, episodes (and files) of each task number, with its description."""
    if file:
        used = ds.frames.groupBy("task_index").agg(
            F.count(F.lit(1)).alias("frames"), F.count_distinct("episode_index").alias("episodes"), F.count_distinct(file).alias("files")
        )
    else:
        used = used_tasks(ds, summary)
    share = F.col("frames") / F.sum("frames").over(Window.partitionBy())
    return used.withColumn("share", share).join(ds.tasks, "task_index", "left").withColumn("defined", F.col("task").isNotNull())
