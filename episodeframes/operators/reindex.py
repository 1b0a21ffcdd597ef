"""Dense numbers. Prefix sums run over the episodes table, by parts, never over frames."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.vectors import frame_time
from ..schema import Dataset, col_
from ..sources.datasets import kept

#: Episodes that a task numbers at a time.
BLOCK = 1 << 16


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (.., length last) of one sorted partition, with its number, and each row's number and the lengths before it in it."""
    from pyspark import TaskContext

    part, no, before = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            rows = batch.slice(i, BLOCK)
            n, lengths = rows.num_rows, pc.fill_null(rows.column(rows.num_columns - 1), 0).to_numpy()
            sums = np.cumsum(lengths)
            more = [pa.array(np.full(n, part, np.int32)), pa.array(no + np.arange(n)), pa.array(before + sums - lengths)]
            yield pa.RecordBatch.from_arrays([*rows.columns, *more], [*rows.schema.names, "_part", "_no", "_before"])
            no, before = no + n, before + int(sums[-1])


def length_prefix(lengths: DataFrame, key: str = "episode_index", carry: Sequence[str] = ()) -> DataFrame:
    """(key, length, carry..., new_episode, first_index): dense number and first frame of each episode, in the order of the key.

    Sampled splitters range the keys into parts of about equal counts, however far apart the keys lie. Each part is numbered as
    it streams by and written once; a row for each part then carries the sums of those before it.
    """
    rows = lengths.select(key, *carry, F.col("length").cast("long").alias("length"))
    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string("_part int, _no long, _before long").fields])
    local = kept(rows.repartitionByRange(key).sortWithinPartitions(key).mapInArrow(_numbered, schema), "numbered")
    sums = local.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.sum("length").alias("_frames"))
    over = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(
        "_part", F.coalesce(F.sum("_n").over(over), F.lit(0)).alias("_no0"), F.coalesce(F.sum("_frames").over(over), F.lit(0)).alias("_at0")
    )
    joined = local.join(F.broadcast(bases), "_part")  # a row for each task
    return joined.select(
        key, "length", *carry, (F.col("_no") + F.col("_no0")).cast("long").alias("new_episode"),
        (F.col("_before") + F.col("_at0")).cast("long").alias("first_index")
    )


def episode_lengths(ds: Dataset) -> DataFrame:
    return ds.episodes.select("episode_index", "length")


def renumber_episodes(ds: Dataset) -> Dataset:
    """Episodes get dense numbers in the order of the old ones; frames of unknown episodes keep theirs."""
    places = length_prefix(episode_lengths(ds)).select("episode_index", "new_episode")
    new = F.coalesce("new_episode", "episode_index")
    frames = ds.frames.join(places, "episode_index", "left").withColumn("episode_index", new).drop("new_episode")
    episodes = ds.episodes.join(places, "episode_index").withColumn("episode_index", F.col("new_episode")).drop("new_episode")
    stats = ds.stats and ds.stats.join(places, "episode_index").withColumn("episode_index", F.col("new_episode")).drop("new_episode")
    return ds.with_(frames=frames, episodes=episodes, stats=stats)


def reindex(ds: Dataset, reset_frame_index: bool = True, reset_timestamp: str | None = None, renumber: bool = True) -> Dataset:
    """Dense episodes (where ``renumber``, else they keep their numbers), frame_index as the place in the episode,
    index as the place in the dataset."""
    places = length_prefix(episode_lengths(ds))
    frames = ds.frames
    if reset_frame_index:
        w = Window.partitionBy("episode_index").orderBy("frame_index", *(c for c in ("index",) if c in frames.columns))
        frames = frames.withColumn("frame_index", (F.row_number().over(w) - 1).cast("long"))
    frames = frames.join(places.drop("length"), "episode_index")
    frames = frames.withColumn("index", F.col("first_index") + F.col("frame_index"))
    if renumber:
        frames = frames.withColumn("episode_index", F.col("new_episode"))
    frames = frames.drop("first_index", "new_episode")
    if reset_timestamp:
        frames = frames.withColumn("timestamp", frame_time(F.col("frame_index"), ds.info.fps, reset_timestamp))
    if not renumber:
        return ds.with_(frames=frames)
    numbers = places.select("episode_index", "new_episode")
    episodes = ds.episodes.join(numbers, "episode_index").withColumn("episode_index", F.col("new_episode")).drop("new_episode")
    stats = ds.stats and ds.stats.join(numbers, "episode_index").withColumn("episode_index", F.col("new_episode")).drop("new_episode")
    return ds.with_(frames=frames, episodes=episodes, stats=stats)


def repair_indices(ds: Dataset) -> tuple[Dataset, DataFrame]:
    """C4: (repaired dataset, one row for each episode that was wrong). Row counts other than the length, or frames that are
    not 0, 1, 2, ..., are an error when the frames are read. Repairing twice changes nothing."""
    w = Window.partitionBy("episode_index")
    place = F.row_number().over(w.orderBy("frame_index")) - 1
    places = length_prefix(episode_lengths(ds))
    df = ds.frames.withColumn("_place", place).withColumn("_rows", F.count(F.lit(1)).over(w)).join(places, "episode_index")
    sound = F.assert_true(
        (F.col("_rows") == F.col("length")) & (F.col("_place") == F.col("frame_index")), F.lit("an episode's rows are not its frames 0 to length - 1")
    )
    df = df.withColumn(
        "_wrong",
        F.when(sound.isNull(), (F.col("index") != F.col("first_index") + F.col("_place")) | (F.col("episode_index") != F.col("new_episode")))
    )
    repaired = df.groupBy("new_episode").agg(F.bool_or("_wrong").alias("wrong")).filter("wrong").select(F.col("new_episode").alias("episode_index"))
    frames = df.withColumn(
        "index", F.when(F.col("_wrong").isNotNull(), F.col("first_index") + F.col("_place"))
    ).withColumn("episode_index", F.col("new_episode"))
    frames = frames.drop("_place", "_rows", "_wrong", "length", "first_index", "new_episode").select(*map(col_, ds.frames.columns))
    numbers = places.select("episode_index", "new_episode")
    episodes = ds.episodes.join(numbers, "episode_index").withColumn(
        "episode_index", F.col("new_episode")
    ).drop("new_episode").select(*map(col_, ds.episodes.columns))
    return ds.with_(frames=frames, episodes=episodes), repaired


def apply_ranges(frames: DataFrame, ranges: DataFrame) -> DataFrame:
    """Frames within half-open ranges (episode_index, start, end); each frame once. Ranges may overlap; empty ones, and
    those without a bound, hold nothing.

    A sweep: frames and the ends of ranges are in one order of their episode, and a frame is kept where a range is open. So
    an episode costs its frames plus its ranges, not their product.
    """
    sound = ranges.filter("episode_index is not null and start < end")
    ends = sound.select("episode_index", F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("open")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("open")))).alias("x"))
    ends = ends.groupBy("episode_index", F.col("x.at").cast("double").alias("_at")).agg(F.sum("x.open").alias("_open"))
    row = F.struct(*map(col_, frames.columns))
    # at one place ends come before frames: 0 before 1
    marks = ends.select("episode_index", "_at", F.lit(0).alias("_kind"), "_open", F.lit(None).cast(frames.schema).alias("_row"))
    rows = frames.filter("episode_index is not null and frame_index is not null").select(
        "episode_index", F.col("frame_index").cast("double").alias("_at"), F.lit(1).alias("_kind"), F.lit(0).cast("long").alias("_open"), row.alias("_row")
    )
    sweep = Window.partitionBy("episode_index").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = rows.unionByName(marks).withColumn("_opened", F.sum("_open").over(sweep))
    return swept.filter("_kind = 1 and _opened > 0").select("_row.*")
