"""Composite jobs. Each takes and returns datasets or reports."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import doubles
from ..operators import augment, merge, occupancy, profile, reindex, select, stats, tasks, transforms, validate, windows
from ..operators.quantiles import exact_quantiles
from ..schema import ACTION, STATE, Dataset, DatasetInfo
from ..sources.datasets import kept, settled, write_report


def recomputed(ds: Dataset, features: Sequence[str] = (STATE, ACTION), widths: dict | None = None, info: bool = True) -> Dataset:
    """D1 and, if ``info``, D17 (which runs a job to count) after an edit."""
    present = [f for f in features if f in ds.frames.columns]
    out = ds.with_(stats=stats.episode_stats(ds.frames, present, widths, previous=ds.stats))
    return out.with_(info=stats.rebuild_info(out)[0]) if info else out


def clean_idle(
    ds: Dataset, head: int = 0, tail: int = 0, features: Sequence[str] = (STATE, ACTION), widths: dict | None = None, info: bool = True, **options
) -> tuple[Dataset, DataFrame]:
    """J1."""
    if head or tail:
        ds = select.trim_frames(ds, head, tail, on_short="drop")
    out, report = windows.filter_idle(ds, **options)
    return recomputed(out, features, widths, info), report


def trim_tails(ds: Dataset, frames: int = 0, seconds: float | None = None, whole: int | None = None) -> Dataset:
    """Episodes keep their numbers. One that is not longer than its tail is an error; where episodes are recorded over
    ``whole`` frames, one that was cut short loses what it has of the tail, and only one without other frames goes."""
    on_short = "error" if whole is None else "drop"
    return recomputed(select.trim_frames(ds, tail=frames, tail_s=seconds, on_short=on_short, whole=whole, renumber=False))


def reject(problems: DataFrame, what: str) -> None:
    """An error that names some of the rows, if there are any."""
    if some := problems.limit(5).collect():
        raise ValueError(f"{what}: {[tuple(r) for r in some]}")


def checked_layout(ds: Dataset, inventory: DataFrame | None = None) -> None:
    """An error where frames and metadata, or files, don't fit (short episodes do)."""
    reject(validate.length_reconciliation(ds).filter("problem <> 'short'"), "frames and lengths don't fit")
    if inventory is not None:
        reject(validate.missing_files(ds, inventory), "files are missing")


def checked_rules(ds: Dataset) -> None:
    """E6 and E7."""
    reject(validate.metadata_violations(ds), "metadata_violations")
    reject(validate.broken_rules(ds, validate.episode_summary(ds)), "index_violations")


def norm_stats(frames: DataFrame, features: dict[str, int]) -> DataFrame:
    """(feature, mean, std, q01, q99) as arrays, for vectors of the given widths."""
    dims = F.explode(
        F.array(
            *(
                F.struct(F.lit(f).alias("feature"), F.lit(i).alias("dim"), F.get(doubles(f), F.lit(i)).alias("x")) for f,
                n in features.items() for i in range(n)
            )
        )
    )
    rows = frames.select(dims.alias("d")).select("d.*")
    moments = rows.groupBy("feature", "dim").agg(F.avg("x").alias("mean"), F.stddev_pop("x").alias("std"))
    both = exact_quantiles(rows, ["feature", "dim"], "x", [0.01, 0.99]).join(moments, ["feature", "dim"])
    measures = {"mean": F.col("mean"), "std": F.col("std"), "q01": F.col("q")[0], "q99": F.col("q")[1]}
    ordered = F.sort_array(F.collect_list(F.struct("dim", *(v.alias(k) for k, v in measures.items()))))  # a row for each dimension
    return both.groupBy("feature").agg(ordered.alias("m")).select("feature", *(F.col(f"m.{k}").alias(k) for k in measures))


def remove(ds: Dataset, selector: str) -> Dataset:
    """Episodes named by a selector; one at least must stay. What is left is held against its lengths (C4)."""
    ds = settled(ds)
    total = ds.episodes.count()
    gone = select.parse_episode_selector(selector, total)
    if len(gone) >= total:
        raise ValueError("no episode would be left")
    return checked_edit(select.remove_episodes(ds, gone))


def checked_edit(out: Dataset) -> Dataset:
    """What every removal ends with: frames held against their lengths (C4) and new totals."""
    out = settled(reindex.repair_indices(out)[0])
    return out.with_(info=stats.rebuild_info(out)[0])


def remove_short(ds: Dataset, min_length: int) -> Dataset:
    """What is left is repaired where needed (C4), and none of it may be short."""
    out = checked_edit(select.remove_short_episodes(settled(ds), min_length))
    reject(out.episodes.filter(F.col("length") < min_length), "short episodes are left")
    return out


def extract_range(ds: Dataset, start: int, end: int) -> Dataset:
    """Source and result are held against E6 and E7. ``extract_with_stats`` also has the statistics."""
    ds = settled(ds)
    checked_rules(ds)
    out = settled(select.extract_episode_range(ds, start, end))
    checked_rules(out)
    return out.with_(info=stats.rebuild_info(out)[0])


def extract_with_stats(ds: Dataset, start: int, end: int, features: Sequence[str] = (STATE, ACTION)) -> tuple[Dataset, DataFrame]:
    """J5 whole: the dataset with its episodes' statistics (those it had, else D1), and those of the result as a whole."""
    out = extract_range(ds, start, end)
    if out.stats is None:
        out = recomputed(out, features, info=False)
    return out, stats.aggregate_stats(out.stats)


def mirror_and_merge(ds: Dataset, joints: Sequence[int]) -> Dataset:
    """J6."""
    return merge.merge_datasets([ds, augment.mirror(ds, joints)])


def decimate_and_merge(ds: Dataset, factor: int) -> Dataset:
    """J7."""
    return merge.merge_datasets([ds, select.decimate(ds, factor)])


def split_and_merge(ds: Dataset, ratio: float, factor: int) -> Dataset:
    """J7 with B9: the source, then the same with a share of its episodes decimated."""
    return merge.merge_datasets([ds, select.decimate_split(ds, ratio, factor)])


def merge_many(datasets: Sequence[Dataset]) -> Dataset:
    """J8."""
    out = merge.merge_datasets(datasets)
    return out.with_(info=stats.rebuild_info(out)[0])


def check_up(ds: Dataset, inventory: DataFrame | None = None) -> DataFrame:
    """One report (check, subject, problem)."""
    return full_check_up(ds, inventory)["problems"]


def full_check_up(ds: Dataset, inventory: DataFrame | None = None) -> dict[str, DataFrame]:
    """J9 with the usage of tasks (D9). Frames are read once: all checks are derived from a summary that is written."""
    ds = settled(ds)
    summary = kept(validate.episode_summary(ds), "summary")
    parts = [
        validate.length_reconciliation(ds, summary).select(F.lit("lengths").alias("check"), F.col("episode_index").cast("string").alias("subject"), "problem"),
        tasks.task_reference_report(ds, summary).select(
            F.lit("tasks").alias("check"), F.col("task_index").cast("string").alias("subject"), F.col("kind").alias("problem")
        ),
        validate.broken_rules(ds, summary).select(
            F.lit("indices").alias("check"), F.col("episode_index").cast("string").alias("subject"), F.col("rule").alias("problem")
        ),
        validate.metadata_violations(ds).select(
            F.lit("metadata").alias("check"), F.concat_ws(" ", "table", F.col("key").cast("string")).alias("subject"), F.col("rule").alias("problem")
        ),
    ]
    if inventory is not None:
        parts.append(validate.missing_files(ds, inventory).select(F.lit("files").alias("check"), F.col("path").alias("subject"), "problem"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return {"problems": out, "usage": tasks.task_usage(ds, summary=summary)}


def to_v21(ds: Dataset, old_stats: DataFrame | None = None, inventory: DataFrame | None = None) -> tuple[Dataset, DataFrame | None]:
    """Layout checks, statistics of all episodes and the new version; (dataset, differences from the old statistics)."""
    checked_layout(ds, inventory)
    out = recomputed(ds.with_(info=replace(ds.info, codebase_version="v2.1")))
    return out, None if old_stats is None else stats.compare_stats(stats.aggregate_stats(out.stats), old_stats)


def jump_report(ds: Dataset, threshold: float = 0.01, dims: Sequence[int] = (6, 13)) -> dict[str, DataFrame]:
    """J11."""
    deltas = windows.frame_deltas(ds.frames, dims=dims)
    spread = profile.histogram(deltas, "delta", ["signal", "dim"])
    return {
        "events": windows.jump_events(deltas, threshold), "histogram": spread, "summary": windows.jump_summary(deltas, threshold),
        "top": windows.top_jump_episodes(deltas)
    }


def occupancy_report(ds: Dataset, size: float = 0.01, k: int = 200) -> dict[str, DataFrame]:
    """J12."""
    poses = kept(occupancy.forward_kinematics(ds.frames), "poses")
    voxels = occupancy.voxelize(poses, size)
    return {
        "voxels": voxels, "top": occupancy.top_voxels(voxels, k, ds.info.fps), "summary": occupancy.position_summary(poses, voxels, ds.info.fps),
        "planes": occupancy.plane_density(poses, size)
    }


def remove_pose_idle(ds: Dataset, min_s: float = 2.0, report: str | None = None, **tolerances) -> Dataset:
    """The episodes found (written as JSON to ``report``, A6) are removed, with the checks of J3."""
    found = kept(windows.pose_idle_episodes(ds.frames, ds.info.fps, min_s, **tolerances), "pose-idle")
    if report:
        write_report(found.orderBy("episode_index"), report, "json")
    return checked_edit(select.remove_episodes(settled(ds), found.select("episode_index")))


def force_deltas(ds: Dataset) -> Dataset:
    """J14."""
    return recomputed(ds.with_(frames=transforms.force_delta(ds.frames, ds.info.names(STATE), action_names=ds.info.names(ACTION) or None)))


def rotation_states(ds: Dataset, positions: Sequence[int] = (0, 1, 2), quaternion: Sequence[int] = (3, 4, 5, 6), gripper: int = 7) -> Dataset:
    """Only the state's statistics are replaced."""
    return recomputed(ds.with_(frames=transforms.quat_state_to_rot6d(ds.frames, positions, quaternion, gripper)), [STATE])


def align(ds: Dataset, reference: DatasetInfo, key_map: dict[str, str], prompt: str, inventory: DataFrame | None = None) -> Dataset:
    """With C10 and C11 on the result."""
    out = select.align_to(ds, reference, key_map, prompt)
    checked_layout(out, inventory)
    return out
