"""Registered queries against their SQL on tables of odd sizes."""

import random

import pytest
from pyspark.sql import functions as F

from episodeframes.functions.vectors import format_path
from episodeframes.operators import select, validate
from episodeframes.plans import catalog, jobs
from episodeframes.schema import Dataset, DatasetInfo

from .helpers import frames_of


def query_and_sql(spark, folder, name: str, ids, without: tuple = ()) -> list[list[tuple]]:
    """Rows of a query and of its SQL over embeddings of these ids; those of the episodes in ``without`` have no vectors."""
    import duckdb

    rng = random.Random(5)
    rows = [(i, None if i // 25 in without else [rng.uniform(-1, 1) for _ in range(64)], i % 10) for i in ids]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet/*.parquet')")
    want = con.sql(catalog.oracle_sql()[name])
    got = catalog.queries()[name](spark, str(folder)).select(*want.columns)
    return [sorted(tuple(r) for r in x) for x in (got.collect(), want.fetchall())]


@pytest.mark.parametrize("ids, without, n", [
    (range(53), (), 3),  # the last episode has 3 frames of 25: fewer than are trimmed
    (range(60), (1,), 3),  # it has 10, which all stay
    ([*range(10, 40), *range(72, 80), *range(97, 100), *range(101, 150, 2)], (), 5),  # gaps; episode 2 holds nothing but tail
    (range(2), (), 1),
])
def test_trimmed_tails_of_episodes_cut_short(spark, tmp_path, ids, without, n):
    got, want = query_and_sql(spark, tmp_path, "j2_trim_tails", ids, without)
    assert len(want) == n and got == want


def test_tails_by_place_in_a_whole_episode(spark):
    ds = Dataset.of_frames(frames_of(spark, {3: [[i] for i in range(5)], 7: [[9], [8]], 9: [[1]] * 4}))
    out = jobs.trim_tails(ds, frames=2, whole=5)
    got = [tuple(r) for r in out.frames.select("episode_index", "frame_index", "index").orderBy("index").collect()]
    assert got == [(3, 0, 0), (3, 1, 1), (3, 2, 2), (7, 0, 3), (7, 1, 4), (9, 0, 5), (9, 1, 6), (9, 2, 7)]
    assert sorted((r.episode_index, r.length) for r in out.episodes.collect()) == [(3, 3), (7, 2), (9, 3)] and out.info.total_frames == 8
    late = ds.with_(frames=ds.frames.filter("episode_index <> 7 or frame_index > 0"))
    assert [r.episode_index for r in jobs.trim_tails(late, frames=4, whole=5).episodes.orderBy("episode_index").collect()] == [3, 9]
    with pytest.raises(Exception, match="only frames that are trimmed"):
        select.trim_frames(late, tail=4, whole=5)
    assert sorted(r.episode_index for r in jobs.trim_tails(ds, frames=1).episodes.collect()) == [3, 7, 9]  # numbers stay
    with pytest.raises(Exception, match="not longer"):
        jobs.trim_tails(ds, frames=2).frames.collect()


def test_aligned_videos_beyond_a_thousand_episodes(spark, tmp_path):
    got, want = query_and_sql(spark, tmp_path, "j16_align", range(0, 25 * 1003, 25))
    assert len(want) == 1003 and got == want


def test_alignment_keeps_the_layout_of_its_dataset(spark):
    """Chunks of the default size, unless the dataset has a path of its own; files elsewhere are missing."""
    ds = Dataset.of_frames(frames_of(spark, {e: [[e]] * 2 for e in (0, 999, 1000, 2001)}), info=DatasetInfo(features={"top": {"dtype": "video"}}))
    reference = DatasetInfo(robot_type="r")
    wanted = [f"videos/chunk-{e // 1000:03d}/front/episode_{e:06d}.mp4" for e in (0, 999, 1000, 2001)]
    data = validate.expected_files(ds).filter("kind = 'data'").select("path").collect()
    files = spark.createDataFrame([(p, 1) for p in [*(r.path for r in data), *wanted]], "path string, length long")
    out = jobs.align(ds, reference, {"top": "front"}, "p", files)
    video = format_path(out.info.video_path, out.info.chunks_size, video_key=F.lit("front"))
    assert sorted(r.v for r in out.episodes.select(video.alias("v")).collect()) == wanted
    flat = files.withColumn("path", F.regexp_replace("path", "videos/chunk-00[12]", "videos/chunk-000"))
    with pytest.raises(ValueError, match="files are missing"):
        jobs.align(ds, reference, {"top": "front"}, "p", flat)
    one = ds.with_(info=DatasetInfo(video_path="videos/chunk-000/{video_key}/episode_{episode_index:06d}.mp4", features=ds.info.features))
    assert jobs.align(one, reference, {"top": "front"}, "p", flat).info.video_path == one.info.video_path
