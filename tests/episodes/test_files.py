"""Episode files and JSON lines as data sources: order of sources, pruning, commit and abort; the check-up's single pass."""

import json
import os
import re

import pytest
from pyspark.sql import functions as F

from episodeframes.operators import profile, reindex, select, validate
from episodeframes.plans import jobs
from episodeframes.schema import STATE, Dataset, DatasetInfo
from episodeframes.sources import datasets, episode_files

from .helpers import frames_of


def dataset(spark, episodes=(0, 3, 1999)):
    return Dataset.of_frames(frames_of(spark, {e: [[float(e), float(i)] for i in range(3 + e % 2)] for e in episodes}), info=DatasetInfo(fps=10))


def files_below(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names if not f.endswith(".crc"))


def test_layout_that_others_read(spark, tmp_path):
    root, ds = f"{tmp_path}/out", dataset(spark)
    datasets.write_dataset(ds, root, "per_episode")
    wanted = [f"data/chunk-{e // 1000:03d}/episode_{e:06d}.parquet" for e in (0, 3, 1999)]
    assert files_below(root) == sorted([*wanted, "meta/episodes.jsonl", "meta/info.json", "meta/tasks.jsonl"])
    with open(f"{root}/meta/episodes.jsonl") as f:
        rows = [json.loads(x) for x in f]
    assert [(r["episode_index"], r["length"]) for r in rows] == [(0, 3), (3, 4), (1999, 4)]
    # backups lie beside the episodes and are not read
    for name in wanted[:2]:
        folder, own = os.path.split(f"{root}/{name}")
        with open(f"{root}/{name}", "rb") as f:
            raw = f.read()
        for copy in (f"{folder}/backup_{own}", f"{folder}/{own}.bak", f"{folder}/episode_000000.bak.parquet"):
            with open(copy, "wb") as f:
                f.write(raw)
    assert datasets.read_frames(spark, root).count() == 11 == datasets.read_episode_files(spark, root).count()
    back = datasets.read_dataset(spark, root)
    assert validate.missing_files(back, datasets.file_inventory(spark, root)).count() == 0
    with pytest.raises(FileExistsError):
        datasets.write_dataset(ds, root, "per_episode")


def test_any_parquet_only_where_there_are_no_episode_files(spark, tmp_path):
    root, ds = f"{tmp_path}/out", dataset(spark)
    datasets.write_dataset(ds, root, "chunked")
    ds.frames.coalesce(1).write.parquet(f"{root}/more")
    part = next(f for f in os.listdir(f"{root}/more") if f.endswith(".parquet"))
    os.rename(f"{root}/more/{part}", f"{root}/data/old_backup.parquet")
    assert datasets.read_frames(spark, root).count() == 11


def test_comparisons_choose_files(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/out"
    datasets.write_dataset(dataset(spark, range(9)), root, "per_episode")
    reader = episode_files.EpisodeReader(root, datasets.read_episode_files(spark, root).schema)
    low, high = episode_files.GreaterThanOrEqual(("episode_index",), 3), episode_files.In(("episode_index",), (1, 4, 8))
    assert list(reader.pushFilters([low, high])) == [low, high]  # Spark evaluates them again
    monkeypatch.setattr(episode_files, "PARTITION_BYTES", 1)
    assert [[e for e, _ in p.files] for p in reader.partitions()] == [[4], [8]]
    os.remove(f"{root}/data/chunk-000/episode_000000.parquet")
    open(f"{root}/data/chunk-000/episode_000000.parquet", "w").close()  # not Parquet: never opened
    f = spark.read.schema("episode_index long, frame_index long").format("episode_files").load(root).filter("episode_index > 6 and frame_index < 2")
    assert sorted(map(tuple, f.collect())) == [(7, 0), (7, 1), (8, 0), (8, 1)]


def test_failed_write_leaves_nothing(spark, tmp_path):
    root, ds = f"{tmp_path}/out", dataset(spark, range(6))
    bad = ds.frames.filter(F.assert_true(F.col("episode_index") < 5, F.lit("a frame that can't be computed")).isNull())
    with pytest.raises(Exception, match="can't be computed"):
        datasets.write_dataset(ds.with_(frames=bad), root, "per_episode")
    assert files_below(root) == []
    with pytest.raises(Exception, match="can't be computed"):
        episode_files.write_lines(bad, f"{root}/meta/x.jsonl", "frame_index")
    assert files_below(root) == []


def test_publishing_again_finishes_what_was_begun(tmp_path):
    import pyarrow as pa

    (tmp_path / "b").write_text("y")
    (tmp_path / "a2").write_text("x")
    rows = pa.RecordBatch.from_pylist([{"attempt": f"{tmp_path}/a1", "path": f"{tmp_path}/b"}, {"attempt": f"{tmp_path}/a2", "path": f"{tmp_path}/d/c"}])
    for _ in range(2):
        list(episode_files._publish(str(tmp_path))([rows]))
        assert files_below(tmp_path) == ["b", "d/c"]
    with pytest.raises(FileNotFoundError):
        list(episode_files._publish(str(tmp_path))([pa.RecordBatch.from_pylist([{"attempt": f"{tmp_path}/none", "path": f"{tmp_path}/e"}])]))


def test_ids_far_apart_make_a_part_for_each_task(spark):
    lengths = spark.range(200).select((F.col("id") * (1 << 40)).alias("episode_index"), (F.col("id") % 7).alias("length"))
    out = reindex.length_prefix(lengths)
    rows = sorted(map(tuple, out.select("new_episode", "episode_index", "first_index").collect()))
    sums = [sum(k % 7 for k in range(i)) for i in range(200)]
    assert rows == [(i, i << 40, sums[i]) for i in range(200)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert out.select("new_episode").rdd.getNumPartitions() <= max(parts, 8)
    assert reindex.length_prefix(lengths.limit(0)).collect() == []


def test_ranges_overlap_touch_and_are_empty(spark):
    f = frames_of(spark, {0: [[1.0]] * 9, 1: [[1.0]] * 5, 2: [[1.0]] * 3})
    spans = [(0, 1, 3), (0, 2, 4), (0, 4, 5), (0, 7, 7), (0, 8, 2), (1, -5, 1), (1, 4, 99), (1, None, 3), (None, 0, 9)]
    ranges = spark.createDataFrame(spans, "episode_index long, start long, end long")
    got = sorted((r.episode_index, r.frame_index) for r in reindex.apply_ranges(f, ranges).collect())
    assert got == [(0, 1), (0, 2), (0, 3), (0, 4), (1, 0), (1, 4)]
    assert reindex.apply_ranges(f, ranges).columns == f.columns
    plan = reindex.apply_ranges(f, ranges)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("n", [1, 2, 5, 17, 100])
def test_even_sample_is_the_closed_form(spark, n):
    df = spark.range(n).repartition(3)
    for k in (1, 2, 3, 7, 16, 50, 200):
        for truncate in (False, True):
            want = select.even_indices(n, k, truncate)
            assert sorted(r.id for r in select.evenly_sample(df, k, ["id"], (), truncate).collect()) == want, (n, k, truncate)


def test_few_values_at_the_limit(spark):
    rows = [(0, i, [float(i % 5), float(i % 6), float(i), None if i % 2 else float("nan"), -0.0 if i % 2 else 0.0]) for i in range(60)]
    f = spark.createDataFrame(rows, f"episode_index long, frame_index long, `{STATE}` array<double>").repartition(4)
    d = {r.dim: r.discrete for r in profile.dimension_summary(f, STATE, [], 5).collect()}
    assert d == {0: True, 1: False, 2: False, 3: False, 4: True}
    shares = [(r.dim, r.value, r.n) for r in profile.discrete_shares(f, STATE, 5).collect() if r.dim in (0, 4)]
    assert sorted(shares) == [(0, float(v), 12) for v in range(5)] + [(4, 0.0, 60)]
    odd = profile.dimension_summary(f.withColumn(STATE, F.expr(f"IF(frame_index = 3, array(1D), `{STATE}`)")), STATE, [], 5).collect()
    assert [(r.dim, r.name) for r in odd] == [(-1, "skipped: widths from 1 to 5")]


def test_check_up_reads_frames_once(spark, tmp_path, monkeypatch):
    root = f"{tmp_path}/out"
    ds = dataset(spark)
    datasets.write_dataset(ds.with_(frames=ds.frames.filter("not (episode_index = 3 and frame_index = 1)")), root, "per_episode")
    stored, plans = datasets.read_dataset(spark, root), []
    own = datasets.kept

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return own(df, name)

    for module in (datasets, jobs, reindex):
        monkeypatch.setattr(module, "kept", watched)
    report = jobs.full_check_up(stored)
    rows = sorted(map(tuple, report["problems"].collect()))
    # E6 without a column index: only the places of episode 3's frames are off
    assert ("indices", "3", "frame_index") in rows and ("lengths", "3", "length") in rows
    assert report["usage"].agg(F.sum("frames")).first()[0] == 10
    plans += [report[k]._jdf.queryExecution().executedPlan().toString() for k in report]
    scans = [re.findall(r"FileScan parquet \[[^\]]*frame_index", p) for p in plans]
    assert sum(map(len, scans)) == 1
