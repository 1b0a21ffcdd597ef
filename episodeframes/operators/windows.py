"""Sequence operators. All share one hash partitioning by episode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.vectors import doubles, exceeds, frame_time, reaches
from ..schema import ACTION, STATE, Dataset
from ..sources.datasets import kept
from .moments import pooled, state
from .quantiles import exact_quantiles
from .reindex import length_prefix


#: The pose looked for by default, six joints and the gripper of the left arm.
TARGET_POSE = (-0.9036, 1.3299, -1.0784, 0.6839, 0.3320, -0.0663, 0.0307)


def in_episode() -> WindowSpec:
    return Window.partitionBy("episode_index").orderBy("frame_index")


def islands(df: DataFrame, flag: str, run: str = "run", size: str = "run_length") -> DataFrame:
    """Maximal runs of equal ``flag`` within an episode: a run number and the run's length in frames."""
    changed = F.coalesce((F.col(flag) != F.lag(flag).over(in_episode())).cast("int"), F.lit(0))
    numbered = df.withColumn(run, F.sum(changed).over(in_episode().rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.withColumn(size, F.count(F.lit(1)).over(Window.partitionBy("episode_index", run)))


def signal(kind: str) -> Column:
    """State and action in one vector of doubles, or one of them."""
    return {"both": F.concat(doubles(STATE), doubles(ACTION)), "state": doubles(STATE), "action": doubles(ACTION)}[kind]


def still(now: Column, before: Column, eps: float) -> Column:
    """Whether every dimension moved by less than eps (never where a number is missing)."""
    return F.forall(F.zip_with(now, before, lambda a, b: F.coalesce(F.abs(a - b) < eps, F.lit(False))), lambda x: x)


def idle_flags(
    frames: DataFrame, kind: str = "both", eps: float = 1e-3, min_idle_len: int = 7, min_nonidle_len: int = 16, filter_last_n: int = 0
) -> DataFrame:
    """The frames with ``keep``. Idle: all dimensions moved by less than eps since the frame before (the first frame never
    is). Idle runs of min_idle_len and more go, then kept runs below min_nonidle_len go, then the last filter_last_n of each
    kept run. Episodes of one frame, or of no dimension, are kept whole."""
    df = frames.withColumn("_signal", signal(kind))
    last = F.lag("_signal").over(in_episode())
    df = df.withColumn("_idle", F.coalesce(last.isNotNull() & still(F.col("_signal"), last, eps), F.lit(False)))
    whole = (F.count(F.lit(1)).over(Window.partitionBy("episode_index")) <= 1) | (F.size("_signal") == 0)
    df = df.withColumn("_whole", whole).drop("_signal")
    df = islands(df, "_idle", "_run", "_n").withColumn("_kept", ~(F.col("_idle") & (F.col("_n") >= min_idle_len)))
    df = islands(df, "_kept", "_run", "_n")
    keep = F.col("_kept") & (F.col("_n") >= min_nonidle_len)
    if filter_last_n:
        back = F.row_number().over(Window.partitionBy("episode_index", "_run").orderBy(F.desc("frame_index")))
        keep = keep & (back > filter_last_n)
    return df.withColumn("keep", F.col("_whole") | keep).drop("_idle", "_kept", "_run", "_n", "_whole")


def idle_ranges(frames: DataFrame, **options) -> DataFrame:
    """Half-open kept ranges: episode_index, start, end."""
    flagged = islands(idle_flags(frames, **options).select("episode_index", "frame_index", "keep"), "keep")
    runs = flagged.filter("keep").groupBy("episode_index", "run").agg(F.min("frame_index").alias("start"), (F.max("frame_index") + 1).alias("end"))
    return runs.select("episode_index", "start", "end")


def filter_report(flagged: DataFrame) -> DataFrame:
    """Per episode before, after, dropped, ratio, skipped."""
    kept = F.count_if("keep")
    return flagged.groupBy("episode_index").agg(F.count(F.lit(1)).alias("before"), kept.alias("after")).select(
        "episode_index", "before", "after", (F.col("before") - F.col("after")).alias("dropped"),
        ((F.col("before") - F.col("after")) / F.col("before")).alias("ratio"), (F.col("after") == 0).alias("skipped"),
    )


def renumbered_frames(kept: DataFrame, fps: float) -> DataFrame:
    """Survivors with dense episode numbers, frame numbers and times; the lengths are counted in the same partitioning."""
    lengths = kept.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"))
    placed = length_prefix(lengths)
    frame = (F.row_number().over(in_episode()) - 1).cast("long")
    df = kept.withColumn("frame_index", frame).join(placed, "episode_index")
    return df.withColumn(
        "index", F.col("first_index") + F.col("frame_index")
    ).withColumn("episode_index", F.col("new_episode")).withColumn("timestamp", frame_time(F.col("frame_index"), fps)).drop("first_index", "new_episode", "length")


def filter_idle(ds: Dataset, **options) -> tuple[Dataset, DataFrame]:
    """E2 on a dataset: (dataset without idle frames, report)."""
    flagged = idle_flags(ds.frames, **options)
    frames = renumbered_frames(flagged.filter("keep").drop("keep"), ds.info.fps)
    return Dataset.of_frames(frames, ds.tasks, ds.info), filter_report(flagged)


def frame_deltas(frames: DataFrame, signals: Sequence[str] = (STATE, ACTION), dims: Sequence[int] = (6, 13)) -> DataFrame:
    """One row for each frame after the first, signal and dimension: prev, curr, delta, direction."""
    extra = [c for c in ("timestamp",) if c in frames.columns]
    picked = [F.struct(F.lit(s).alias("signal"), F.lit(d).alias("dim"), F.get(doubles(s), F.lit(d)).alias("curr")) for s in signals for d in dims]
    before = [
        F.struct(
            F.lit(s).alias("signal"), F.lit(d).alias("dim"), F.lag(F.get(doubles(s), F.lit(d))).over(in_episode()).alias("prev")
        ) for s in signals for d in dims
    ]
    rows = frames.select(
        "episode_index", "frame_index", *extra, F.arrays_zip(F.array(*picked).alias("now"), F.array(*before).alias("then")).alias("z"),
        F.row_number().over(in_episode()).alias("n")
    )
    df = rows.filter("n > 1").select("episode_index", "frame_index", *extra, F.explode("z").alias("z")).select(
        "episode_index", "frame_index", *extra, F.col("z.now.signal").alias("signal"), F.col("z.now.dim").alias("dim"),
        F.col("z.then.prev").alias("prev"), F.col("z.now.curr").alias("curr")
    )
    delta = F.col("curr") - F.col("prev")
    return df.withColumn("delta", delta).withColumn(
        "direction", F.when(F.col("delta") > 0, "open").when(F.col("delta") < 0, "close").otherwise("zero")
    )


def jump_events(deltas: DataFrame, threshold: float = 0.01) -> DataFrame:
    return deltas.filter(reaches(F.col("delta"), threshold))


def jump_summary(deltas: DataFrame, threshold: float = 0.01, exact: bool = True) -> DataFrame:
    """Per (signal, dim). Percentiles are exact with linear interpolation, or from a sketch if not ``exact``.

    Two levels, episodes first: so numbers of episodes are sums, the first of the largest jumps carries over, and mean and
    deviation are pooled from the episodes'. The deltas are written once, as their windows feed two aggregations.
    """
    deltas = kept(deltas.select("signal", "dim", "episode_index", "frame_index", "delta"), "deltas")
    hit, size = reaches(F.col("delta"), threshold), F.abs("delta")
    group, places = ["signal", "dim"], {"p50": 0.5, "p95": 0.95, "p99": 0.99, "p999": 0.999}
    kinds = {"abnormal": hit, "open": hit & (F.col("delta") > 0), "close": hit & (F.col("delta") < 0)}
    if exact:
        quantiles = exact_quantiles(deltas, group, "delta", list(places.values()))
    else:
        quantiles = deltas.groupBy(*group).agg(F.percentile_approx("delta", F.array(*map(F.lit, places.values())), F.lit(10_000)).alias("q"))
    largest = F.struct(size.alias("size"), (-F.col("episode_index")).alias("e"), (-F.col("frame_index")).alias("f"), "delta")
    each = deltas.groupBy(*group, "episode_index").agg(
        F.count("delta").alias("n"), F.avg("delta").alias("_mean"), F.stddev_pop("delta").alias("_std"), F.min("delta").alias("min"), F.max("delta").alias("max"),
        F.max(F.when(F.col("delta").isNotNull(), largest)).alias("_top"), *(F.count_if(x).alias(f"{k}_frames") for k, x in kinds.items()),
    )
    each = each.withColumns({f"{k}_episodes": (F.col(f"{k}_frames") > 0).cast("long") for k in kinds})
    ends = [F.min("min").alias("min"), F.max("max").alias("max"), F.max("_top").alias("_top")]
    ends += [F.sum(c).alias(c) for c in ("n", *(f"{k}_{x}" for k in kinds for x in ("frames", "episodes")))]
    rows = pooled(each, group, F.col("episode_index"), state(F.col("n"), F.col("_mean"), F.col("_std")), ends, ends)
    named = quantiles.select(*group, *(F.col("q")[i].alias(name) for i, name in enumerate(places)))
    out = rows.join(F.broadcast(named), group, "left")  # a row for each signal and dimension
    return out.select(
        *group, "n", "mean", "std", "min", "max", *places, F.col("_top.size").alias("abs_max"), F.col("_top.delta").alias("abs_max_delta"), "abnormal_frames",
        (F.col("abnormal_frames") / F.col("n")).alias("abnormal_ratio"), "abnormal_episodes", "open_frames", "close_frames", "open_episodes", "close_episodes",
    )


def top_jump_episodes(deltas: DataFrame, k: int = 3) -> DataFrame:
    """The k episodes with the largest jump of each (signal, dim); ties: the lower episode first."""
    each = deltas.groupBy("signal", "dim", "episode_index").agg(
        F.max(F.abs("delta")).alias("abs_max"), F.max(F.when(F.col("delta") > 0, F.col("delta"))).alias("max_open"),
        F.min(F.when(F.col("delta") < 0, F.col("delta"))).alias("max_close")
    )
    rank = F.row_number().over(Window.partitionBy("signal", "dim").orderBy(F.desc("abs_max"), "episode_index"))
    return each.withColumn("rank", rank).filter(F.col("rank") <= k)


def pose_flags(
    frames: DataFrame, target: Sequence[float] = TARGET_POSE, joint_tol: float = 0.15, gripper_tol: float = 0.01, still_tol: float = 0.001
) -> DataFrame:
    """Frames near the target pose (six joints and the gripper) that also stand still; all bounds are inclusive."""
    state = doubles(STATE)
    near = F.lit(True)
    for i, t in enumerate(target):
        near = near & (F.abs(state[i] - t) <= (joint_tol if i < 6 else gripper_tol))
    rest = F.lit(True)
    for i in range(7):
        rest = rest & (F.abs(state[i] - F.lag(state[i]).over(in_episode())) <= still_tol)
    first = F.row_number().over(in_episode()) == 1
    return frames.select("episode_index", "frame_index", F.coalesce(near & (first | rest), F.lit(False)).alias("idle"))


def pose_idle_segments(frames: DataFrame, fps: float, min_s: float = 2.0, **tolerances) -> DataFrame:
    """Maximal runs at the pose of more than min_s seconds: episode_index, start, end (half-open), frames, seconds."""
    runs = islands(pose_flags(frames, **tolerances), "idle").filter("idle")
    found = runs.groupBy("episode_index", "run").agg(F.min("frame_index").alias("start"), (F.max("frame_index") + 1).alias("end"))
    return found.withColumn(
        "frames", F.col("end") - F.col("start")
    ).withColumn("seconds", F.col("frames") / fps).filter(F.col("seconds") > min_s).drop("run")


def pose_idle_episodes(frames: DataFrame, fps: float, min_s: float = 2.0, **tolerances) -> DataFrame:
    """Per episode the number of segments and the longest (of ties the earliest)."""
    longest = F.max_by(F.struct("start", "end", "seconds"), F.struct("frames", -F.col("start"))).alias("x")
    return pose_idle_segments(frames, fps, min_s, **tolerances).groupBy("episode_index").agg(F.count(F.lit(1)).alias("segments"), longest).select(
        "episode_index", "segments", "x.start", "x.end", "x.seconds"
    )


def timestamp_gaps(frames: DataFrame, fps: float, tol: float = 1e-4, max_per_episode: int = 5) -> DataFrame:
    """Frames whose step from the one before is off by more than tol; the first few of each episode."""
    time = F.col("timestamp").cast("double")
    off = F.abs(time - F.lag(time).over(in_episode()) - 1.0 / fps)
    bad = frames.select("episode_index", "frame_index", "timestamp", off.alias("off")).filter(exceeds(F.col("off"), tol))
    return bad.withColumn("no", F.row_number().over(in_episode())).filter(F.col("no") <= max_per_episode)


def fix_timestamps(frames: DataFrame, fps: float, episodes: Sequence[int] | None = None, tol: float = 1e-4) -> DataFrame:
    """E5: episodes with a bad step get round5(i / fps); others, and those not asked for, stay."""
    time = F.col("timestamp").cast("double")
    bad = F.coalesce(exceeds(time - F.lag(time).over(in_episode()) - 1.0 / fps, tol), F.lit(False))
    place = F.row_number().over(in_episode()) - 1
    df = frames.withColumn("_bad", bad).withColumn("_place", place)
    broken = F.bool_or("_bad").over(Window.partitionBy("episode_index"))
    if episodes is not None:
        broken = broken & F.col("episode_index").isin(list(episodes))
    return df.withColumn("timestamp", F.when(broken, frame_time(F.col("_place"), fps)).otherwise(F.col("timestamp"))).drop("_bad", "_place")
