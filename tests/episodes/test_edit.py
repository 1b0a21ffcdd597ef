"""Selecting, renumbering, merging, tasks, reading and writing."""

import json

import pytest
from pyspark.sql import functions as F

from episodeframes.operators import merge, reindex, select, stats, tasks, validate
from episodeframes.plans import jobs
from episodeframes.schema import ACTION, STATE, Dataset, DatasetInfo, col_, resolve_key
from episodeframes.sources import datasets

from .helpers import LENGTHS, range_dataset


def rows(df, *cols, order=None):
    return [tuple(r) for r in df.select(*(col_(c) for c in cols)).orderBy(*(col_(c) for c in order or cols)).collect()]


def test_extract_range(spark):
    ds = range_dataset(spark)
    out = select.extract_episode_range(ds, 1, 3)
    assert rows(out.episodes, "episode_index", "length", "tasks") == [(0, 3, ["gamma"]), (1, 2, ["gamma"]), (2, 2, ["beta"])]
    assert rows(out.tasks, "task_index", "task") == [(0, "beta"), (1, "gamma")]
    got = rows(out.frames, "index", "episode_index", "frame_index", "task_index")
    assert got == [(0, 0, 0, 1), (1, 0, 1, 1), (2, 0, 2, 1), (3, 1, 0, 1), (4, 1, 1, 1), (5, 2, 0, 0), (6, 2, 1, 0)]
    info, changed = stats.rebuild_info(out)
    assert (
        info.total_episodes, info.total_frames, info.total_chunks, info.total_videos, info.splits
    ) == (3, 7, 2, 3, {"train": "0:3"}) and changed["total_episodes"] == (999, 3)
    agg = stats.aggregate_stats(out.stats).first()
    assert (agg["min"], agg["max"], agg.n) == (2, 4, 7) and agg["mean"] == pytest.approx((2 * 3 + 3 * 2 + 4 * 2) / 7)


def test_extract_whole_and_one(spark):
    ds = range_dataset(spark)
    whole = select.extract_episode_range(ds, 0, 4)
    assert rows(whole.frames, "index", "episode_index", "task_index") == rows(ds.frames, "index", "episode_index", "task_index")
    assert rows(select.extract_episode_range(ds, 4, 4).frames, "episode_index", "index", "task_index") == [(0, 0, 0)]


@pytest.mark.parametrize("start,end", [(-1, 1), (2, 1), (0, 5)])
def test_bad_ranges(spark, start, end):
    with pytest.raises(ValueError):
        select.extract_episode_range(range_dataset(spark), start, end)


def test_job_rejects_gaps(spark):
    ds = range_dataset(spark)
    gap = ds.with_(episodes=ds.episodes.withColumn("episode_index", F.when(F.col("episode_index") == 4, 7).otherwise(F.col("episode_index"))))
    assert {(r.table, r.key, r.rule) for r in validate.metadata_violations(gap).collect()} == {("episodes", 7, "gap")}
    with pytest.raises(ValueError):
        jobs.extract_range(gap, 0, 1)
    assert jobs.extract_range(ds, 1, 3).info.total_frames == 7


def test_repair_is_idempotent(spark):
    ds = range_dataset(spark)
    stale = ds.with_(frames=ds.frames.withColumn("index", F.col("episode_index") * 100 + 100 + F.col("frame_index")))
    fixed, changed = reindex.repair_indices(stale)
    assert changed.count() == 5 and [r[0] for r in rows(fixed.frames, "index")] == list(range(10))
    assert reindex.repair_indices(fixed)[1].count() == 0
    with pytest.raises(Exception, match="not its frames"):
        reindex.repair_indices(ds.with_(frames=ds.frames.filter("index <> 3")))[0].frames.collect()


def test_writer_renumbers(spark):
    f = spark.createDataFrame(
        [(5, 0, 100, 1.0), (5, 1, 101, 2.0), (8, 0, 900, 3.0)], "episode_index long, frame_index long, index long, value double"
    ).withColumn("task_index", F.lit(0).cast("long"))
    out = reindex.reindex(Dataset.of_frames(f))
    assert rows(out.frames, "episode_index", "frame_index", "index", "value") == [(0, 0, 0, 1.0), (0, 1, 1, 2.0), (1, 0, 2, 3.0)]


def test_prefix_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(reindex, "BLOCK", 7)
    lengths = spark.createDataFrame([(i * 3, i % 5 + 1) for i in range(100)], "episode_index long, length long")
    at = 0
    for r in sorted(reindex.length_prefix(lengths).collect(), key=lambda r: r.episode_index):
        assert (r.new_episode, r.first_index) == (r.episode_index // 3, at)
        at += r.length


def test_select_remove_head_label(spark):
    ds = range_dataset(spark)
    assert rows(select.select_episodes(ds, [1, 3]).episodes, "episode_index", "length") == [(0, 3), (1, 2)]
    assert rows(
        select.remove_episodes(ds, [1, 3]).frames, "index", "episode_index", "task_index"
    ) == [(0, 0, 0), (1, 0, 0), (2, 1, 1), (3, 1, 1), (4, 2, 0)]
    assert select.remove_short_episodes(ds, 2).episodes.count() == 4
    assert rows(select.head_episodes(ds, 2).episodes, "episode_index") == [(0,), (1,)]
    assert [r.terminated for r in select.label_terminated(ds.episodes, 3).orderBy("episode_index").collect()] == [False, False, False, True, True]
    for bad in ("length", "tasks"):
        with pytest.raises(ValueError):
            select.label_terminated(ds.episodes, 3, bad)
    named = select.select_episodes(ds, [0], {0: "new"})
    assert rows(named.episodes, "tasks") == [(["alpha", "new"],)] and rows(named.tasks, "task_index", "task") == [(0, "alpha"), (1, "new")]


def test_selector():
    p = select.parse_episode_selector
    assert p("1,3,5-7 x -2", 7) == [1, 3, 5, 6] and p("[4, 2]", 9) == [2, 4] and p('{"a": [1], "b": [2, 1]}', 9) == [1, 2] and p("", 9) == []
    with pytest.raises(ValueError):
        p("9", 9, strict=True)


def test_trim_and_decimate(spark):
    ds = range_dataset(spark)
    got = select.trim_frames(ds, head=1, on_short="drop")
    assert rows(got.frames, "episode_index", "frame_index", "index") == [(0, 0, 0), (1, 0, 1), (1, 1, 2), (2, 0, 3), (3, 0, 4)]
    with pytest.raises(Exception, match="not longer"):
        select.trim_frames(ds, tail=1).frames.collect()
    thin = select.decimate(ds, 2)
    assert rows(
        thin.episodes, "episode_index", "length"
    ) == [(0, 1), (1, 2), (2, 1), (3, 1), (4, 1)] and rows(thin.frames, "index", "frame_index")[2] == (2, 1)
    split = select.decimate_split(ds, 0.5, 2)
    assert rows(split.episodes, "episode_index", "length") == [(0, 1), (1, 2), (2, 2), (3, 2), (4, 1)]
    assert rows(select.decimate_split(ds, 0.01, 2).episodes, "length", order=["episode_index"]) == [(1,), (3,), (2,), (2,), (1,)]


def test_even_sampling(spark):
    assert select.even_indices(10, 4) == [0, 3, 6, 9] and select.even_indices(3, 5) == [0, 1, 2] and select.even_indices(5, 1) == [0]
    df = spark.range(10).withColumn("g", F.lit(1))
    assert rows(select.evenly_sample(df, 4, ["id"], ["g"]), "id") == [(0,), (3,), (6,), (9,)]


def test_merge_then_extract_is_identity(spark):
    a, b = range_dataset(spark), range_dataset(spark)
    b = b.with_(tasks=spark.createDataFrame([(0, "gamma"), (1, "delta"), (2, "alpha")], "task_index long, task string"))
    out = merge.merge_datasets([a, b])
    assert rows(out.tasks, "task_index", "task") == [(0, "alpha"), (1, "beta"), (2, "gamma"), (3, "delta")]
    assert [r[0] for r in rows(out.frames, "index")] == list(range(20)) and rows(
        out.episodes, "length", order=["episode_index"]
    ) == [(n,) for n in LENGTHS * 2]
    assert {(r.episode_index, r.task_index) for r in out.frames.collect() if r.episode_index >= 5} == {(5, 2), (6, 0), (7, 0), (8, 3), (9, 2)}
    back = select.extract_episode_range(merge.merge_datasets([a, a]), 0, 4)
    assert rows(back.frames, "index", "episode_index", "task_index", STATE) == rows(a.frames, "index", "episode_index", "task_index", STATE)
    with pytest.raises(ValueError):
        merge.merge_datasets([a, a.with_(info=DatasetInfo(fps=11, features=a.info.features))])
    with pytest.raises(ValueError):
        merge.merge_datasets([a, a.with_(info=DatasetInfo(fps=10, features={}))])
    with pytest.raises(ValueError):
        merge.merge_datasets([])


def test_tasks(spark):
    ds = range_dataset(spark)
    odd = ds.with_(tasks=spark.createDataFrame([(1, "beta"), (2, "gamma"), (9, "unused")], "task_index long, task string"))
    assert {(r.kind, r.task_index) for r in tasks.task_reference_report(odd).collect()} == {("missing", 0), ("extra", 9)}
    one = tasks.unify_tasks(odd)
    assert rows(one.tasks, "task_index", "task") == [(0, "beta")] and rows(one.episodes, "tasks")[0] == (["beta"],)
    assert (0, "unknown task 0") in rows(tasks.fill_missing_tasks(odd).tasks, "task_index", "task")
    use = {r.task_index: (r.frames, r.episodes, r.defined) for r in tasks.task_usage(odd).collect()}
    assert use == {0: (3, 2, False), 1: (2, 1, True), 2: (5, 2, True)}
    empty = tasks.unify_tasks(ds.with_(tasks=ds.tasks.limit(0)))
    assert rows(empty.tasks, "task") == [("default task",)]
    with pytest.raises(Exception, match="lacks"):
        tasks.remap_tasks(odd, "strict").frames.collect()


def test_keys_and_names(spark):
    assert resolve_key(["state", "action"], None, ("observation.state", "state")) == "state"
    with pytest.raises(ValueError):
        resolve_key(["state", "observation.state"], None, ("observation.state", "state"), "error")
    ds = range_dataset(spark)
    out = select.rename_features(ds, {STATE: "state"})
    assert "state" in out.frames.columns and "state" in out.info.features and list(out.stats.first().stats) == ["state"]
    with pytest.raises(ValueError):
        select.rename_features(ds, {STATE: ACTION})
    assert "action" not in select.drop_features(ds, [ACTION]).frames.columns
    aligned = select.align_to(ds, DatasetInfo(robot_type="r"), {"observation.images.top": "observation.images.high"}, "do it")
    assert aligned.info.robot_type == "r" and "observation.images.high" in aligned.info.features and rows(aligned.tasks, "task") == [("do it",)]
    view = select.episode_view(ds, 1).collect()
    assert [round(r.timestamp, 2) for r in view] == [0.0, 0.1, 0.2]


@pytest.mark.parametrize("layout", ["per_episode", "chunked"])
def test_round_trip_on_disk(spark, tmp_path, layout):
    ds, root = range_dataset(spark), str(tmp_path / "out")
    datasets.write_dataset(ds, root, layout)
    with pytest.raises(FileExistsError):
        datasets.write_dataset(ds, root, layout)
    back = datasets.read_dataset(spark, root)
    assert rows(
        back.frames, "index", "episode_index", "frame_index", "task_index", STATE
    ) == rows(ds.frames, "index", "episode_index", "frame_index", "task_index", STATE)
    assert rows(back.episodes, "episode_index", "tasks", "length") == rows(ds.episodes, "episode_index", "tasks", "length")
    assert back.info == ds.info and back.stats.count() == 5
    if layout == "per_episode":
        assert (tmp_path / "out/data/chunk-001/episode_000003.parquet").exists()
        # the number comes from the file's name where the column lacks
        bare = datasets.read_frames(spark, root).drop("episode_index")
        assert "episode_index" not in bare.columns


def test_reads_foreign_files(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    (tmp_path / "data/chunk-000").mkdir(parents=True)
    (tmp_path / "meta").mkdir()
    for e in (0, 1):
        pq.write_table(
            pa.table({STATE: pa.array([[1.0], [2.0]], pa.list_(pa.float32(), 1)), "index": [[2 * e], [2 * e + 1]]}),
            tmp_path / f"data/chunk-000/episode_{e:06d}.parquet"
        )
    (tmp_path / "meta/tasks.jsonl").write_text('{"task_index": 0, "task": "a"}\n\n{"task_index": 1, "task": "b"}\n')
    f = datasets.read_frames(spark, str(tmp_path))
    assert rows(f, "episode_index", "frame_index", "index") == [(0, 0, 0), (0, 1, 1), (1, 0, 2), (1, 1, 3)]
    assert datasets.read_tasks(spark, str(tmp_path)).count() == 2 and datasets.read_episode_stats(spark, str(tmp_path)).count() == 0
    (tmp_path / "meta/tasks.jsonl").write_text("{bad\n")
    with pytest.raises(Exception):
        datasets.read_tasks(spark, str(tmp_path)).collect()
    inventory = datasets.file_inventory(spark, str(tmp_path), "*.parquet")
    assert rows(inventory, "path", "empty") == [(f"data/chunk-000/episode_{e:06d}.parquet", False) for e in (0, 1)]
    datasets.write_report(f.select("index"), str(tmp_path / "report"), "json")
    assert json.loads(next((tmp_path / "report").glob("*.json")).read_text().splitlines()[0])


def test_checks(spark):
    ds = range_dataset(spark)
    assert jobs.check_up(ds).filter("problem <> 'short'").count() == 0
    short = validate.length_reconciliation(ds.with_(frames=ds.frames.filter("index <> 3 and episode_index <> 0")))
    assert {(r.episode_index, r.problem) for r in short.collect()} == {(0, "no_frames"), (1, "length"), (4, "short")}
    stale = ds.with_(frames=ds.frames.withColumn("index", F.col("index") + F.when(F.col("episode_index") == 2, 1).otherwise(0)))
    assert {r.episode_index for r in validate.index_violations(stale).collect()} == {2}
    files = validate.expected_files(ds)
    assert files.count() == 10 and ("videos/chunk-001/observation.images.top/episode_000003.mp4",) in rows(files, "path")
    gone = validate.missing_files(
        ds, files.filter("path not like '%000003%'").withColumn("length", F.when(F.col("path").contains("000001.mp4"), 0).otherwise(5))
    )
    assert sorted(r.problem for r in gone.collect()) == ["empty", "missing", "missing"]
