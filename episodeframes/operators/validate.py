"""Checks that return the rows that break a rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import doubles, format_path
from ..schema import Dataset, col_
from .reindex import length_prefix


def expected_files(ds: Dataset) -> DataFrame:
    """path, kind: one data file for each episode, one video for each episode and declared video key."""
    size = ds.info.chunks_size
    data = ds.episodes.select(format_path(ds.info.data_path, size).alias("path"), F.lit("data").alias("kind"))
    if not ds.info.video_keys():
        return data
    keyed = ds.episodes.withColumn("video_key", F.explode(F.array(*map(F.lit, ds.info.video_keys()))))
    return data.unionByName(keyed.select(format_path(ds.info.video_path, size).alias("path"), F.lit("video").alias("kind")))


def missing_files(ds: Dataset, inventory: DataFrame) -> DataFrame:
    """Expected files that are missing or empty. ``inventory``: (path, length)."""
    found = expected_files(ds).join(inventory.select("path", "length"), "path", "left")
    return found.filter("length is null or length = 0").select(
        "path", "kind", F.when(F.col("length").isNull(), "missing").otherwise("empty").alias("problem")
    )


def episode_summary(ds: Dataset) -> DataFrame:
    """What the checks of a dataset need of its frames, in one pass: a row for each (episode, task) with its frames, those whose
    frame_index is not their place, and of the others those without index and the extremes of index less place."""
    w = Window.partitionBy("episode_index").orderBy("frame_index", *(c for c in ("index",) if c in ds.frames.columns))
    place = (F.row_number().over(w) - 1).cast("long")
    index = F.col("index") if "index" in ds.frames.columns else F.lit(None).cast("long")
    df = ds.frames.select("episode_index", "task_index", F.coalesce(F.col("frame_index") == place, F.lit(False)).alias("_in"), (index - place).alias("_first"))
    first = F.when(F.col("_in"), F.col("_first"))
    return df.groupBy("episode_index", "task_index").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("_in")).alias("misplaced"), F.count_if(F.col("_in") & F.col("_first").isNull()).alias("unnumbered"),
        F.min(first).alias("first_low"), F.max(first).alias("first_high"),
    )


def broken_rules(ds: Dataset, summary: DataFrame) -> DataFrame:
    """(episode_index, rule): E6 by episode, from the summary."""
    each = summary.groupBy("episode_index").agg(
        F.sum("misplaced").alias("misplaced"), F.sum("unnumbered").alias("unnumbered"), F.min("first_low").alias("low"), F.max("first_high").alias("high"),
        F.sum(F.col("rows") - F.col("misplaced")).alias("placed")
    )
    places = length_prefix(ds.episodes.select("episode_index", "length")).select("episode_index", "first_index")
    df = each.join(places, "episode_index", "left")
    off = F.coalesce((F.col("low") != F.col("first_index")) | (F.col("high") != F.col("first_index")), F.lit(False))
    wrong = (F.col("unnumbered") > 0) | off | (F.col("first_index").isNull() & (F.col("placed") > 0))
    if "index" not in ds.frames.columns:
        wrong = F.lit(False)
    rules = F.array(F.when(F.col("misplaced") > 0, "frame_index"), F.when(wrong, "index"))
    return df.select("episode_index", F.explode(rules).alias("rule")).filter("rule is not null")


def length_reconciliation(ds: Dataset, summary: DataFrame | None = None) -> DataFrame:
    """C11: episodes whose frames don't fit their length: no_frames, no_metadata, length, short (fewer than two frames)."""
    counted = F.count(F.lit(1)) if summary is None else F.sum("rows")
    rows = (ds.frames if summary is None else summary).groupBy("episode_index").agg(counted.alias("rows"))
    both = rows.join(ds.episodes.select("episode_index", "length"), "episode_index", "full")
    problem = F.when(F.col("rows").isNull(), "no_frames").when(F.col("length").isNull(), "no_metadata").when(
        F.col("rows") != F.col("length"), "length"
    ).when(F.col("rows") < 2, "short")
    return both.withColumn("problem", problem).filter("problem is not null")


def index_violations(ds: Dataset) -> DataFrame:
    """Frames whose frame_index or index is null or not where its episode's place and the lengths before it put it."""
    w = Window.partitionBy("episode_index").orderBy("frame_index", *(c for c in ("index",) if c in ds.frames.columns))
    places = length_prefix(ds.episodes.select("episode_index", "length")).select("episode_index", "first_index")
    df = ds.frames.withColumn("_place", F.row_number().over(w) - 1).join(places, "episode_index", "left")
    rule = F.when(F.col("frame_index").isNull() | (F.col("frame_index") != F.col("_place")), "frame_index")
    if "index" in ds.frames.columns:
        rule = rule.when(
            F.col("index").isNull() | F.col("first_index").isNull() | (F.col("index") != F.col("first_index") + F.col("_place")), "index"
        )
    return df.withColumn("rule", rule).filter("rule is not null").select("episode_index", "frame_index", "rule")


def metadata_violations(ds: Dataset) -> DataFrame:
    """(table, key, rule): keys unique and contiguous from 0, lengths positive, tasks known, names unique and not null."""

    def keys(df: DataFrame, table: str, key: str) -> DataFrame:
        counted = df.groupBy(F.col(key).cast("long").alias("key")).agg(F.count(F.lit(1)).alias("n"))
        # contiguous from 0: every key but 0 has the one below it
        below = counted.select((F.col("key") + 1).alias("key"))
        gap = counted.filter("key <> 0").join(below, "key", "left_anti").select("key", F.lit("gap").alias("rule"))
        twice = counted.filter("n > 1").select("key", F.lit("unique").alias("rule"))
        return gap.unionByName(twice).select(F.lit(table).alias("table"), "key", "rule")

    def rows(df: DataFrame, table: str, rule: str) -> DataFrame:
        return df.select(F.lit(table).alias("table"), "key", F.lit(rule).alias("rule"))

    episodes, tasks = ds.episodes.withColumn("key", F.col("episode_index")), ds.tasks.withColumn("key", F.col("task_index"))
    named = episodes.select("key", F.explode("tasks").alias("task"))
    out = [
        keys(ds.episodes, "episodes", "episode_index"), keys(ds.tasks, "tasks", "task_index"),
        rows(episodes.filter("length is null or length <= 0"), "episodes", "length"),
        rows(named.join(ds.tasks, "task", "left_anti").select("key").distinct(), "episodes", "task"),
        rows(tasks.filter("task is null"), "tasks", "name"),
        rows(tasks.join(tasks.groupBy("task").count().filter("count > 1"), "task", "left_semi"), "tasks", "name"),
    ]
    if ds.stats is not None:
        out.append(keys(ds.stats, "episodes_stats", "episode_index"))
    df = out[0]
    for x in out[1:]:
        df = df.unionByName(x)
    return df


def vector_violations(frames: DataFrame, key: str, dims: Sequence[int] | None = None, width: int | None = None) -> DataFrame:
    """rows whose vector is null, has another width than most first rows declare (or ``width``), or a number that is not
    finite among ``dims``."""
    v = doubles(key)
    if width is None:
        row = frames.select(F.mode(F.size(col_(key))).alias("n")).first()
        width = row.n if row and row.n is not None else 0
    picked = v if dims is None else F.array(*(F.get(v, F.lit(i)) for i in dims))
    finite = F.forall(picked, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rule = F.when(v.isNull(), "null").when(F.size(v) != width, "width").when(~finite, "not finite")
    return frames.withColumn("rule", rule).filter("rule is not null").select("episode_index", "frame_index", "rule")
