"""Windows, statistics, profiles, mirroring, transforms and kinematics against numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from episodeframes.functions.kinematics import RIGHT_BASE, base_column, pose_of, with_pose
from episodeframes.functions.vectors import format_path, mirror_vector
from episodeframes.operators import augment, latency, merge, occupancy, profile, select, stats, transforms, validate, video, windows
from episodeframes.operators.quantiles import exact_quantiles
from episodeframes.plans import jobs
from episodeframes.schema import ACTION, STATE, Dataset, DatasetInfo, col_

from .helpers import frames_of, range_dataset


def idle_oracle(x, eps, min_idle, min_nonidle, last_n):
    """Kept frames of one episode."""
    if len(x) <= 1:
        return list(range(len(x)))
    x = np.asarray(x, float).reshape(len(x), -1)
    idle = np.concatenate([[False], (np.abs(np.diff(x, axis=0)) < eps).all(axis=1)])

    def runs(mask):
        out, i = [], 0
        while i < len(mask):
            j = i
            while j < len(mask) and mask[j] == mask[i]:
                j += 1
            out.append((i, j, bool(mask[i])))
            i = j
        return out

    keep = np.ones(len(x), bool)
    for a, b, flag in runs(idle):
        if flag and b - a >= min_idle:
            keep[a:b] = False
    for a, b, flag in runs(keep):
        if flag and b - a < min_nonidle:
            keep[a:b] = False
    for a, b, flag in runs(keep):
        if flag:
            keep[max(a, b - last_n) : b] = False
    return np.flatnonzero(keep).tolist()


@pytest.mark.parametrize("last_n", [0, 2])
def test_idle_filter(spark, last_n):
    rnd = random.Random(1)
    episodes = {0: [], 1: [1], 2: [1, 1], 3: [0, 1e-3, 2e-3, 2e-3 + 1e-9] * 8, 4: [5] * 40}
    for e in range(5, 60):
        x, out = 0.0, []
        for _ in range(rnd.randrange(1, 12)):
            moving = rnd.random() < 0.5
            for _ in range(rnd.choice([1, 5, 6, 7, 8, 15, 16, 17])):
                x += rnd.choice([0.5, 1.0]) if moving else 0.0
                out.append(x)
        episodes[e] = out
    got = {}
    for r in windows.idle_flags(frames_of(spark, episodes), filter_last_n=last_n).filter("keep").collect():
        got.setdefault(r.episode_index, []).append(r.frame_index)
    want = {e: k for e, x in episodes.items() if (k := idle_oracle(x, 1e-3, 7, 16, last_n))}
    assert {e: sorted(k) for e, k in got.items()} == want


def test_idle_job_rebuilds(spark):
    rnd = random.Random(2)
    ds = Dataset.of_frames(frames_of(spark, {e: [0.0] * 30 if e % 3 == 0 else [rnd.random() for _ in range(20 + e)] for e in range(9)}))
    out, report = jobs.clean_idle(ds)
    f = sorted(out.frames.collect(), key=lambda r: r["index"])
    assert [r["index"] for r in f] == list(range(len(f))) and {r.episode_index for r in f} == set(range(6))
    assert all(r.timestamp == pytest.approx(round(r.frame_index / 30, 5), abs=1e-6) for r in f)
    assert sorted(r.episode_index for r in report.filter("skipped").collect()) == [0, 3, 6]
    assert out.info.total_episodes == 6 and out.stats.count() == 6


def test_one_exchange_of_frames(spark):
    """All windows of the idle filter share one partitioning."""
    df = windows.idle_flags(frames_of(spark, {0: [1, 2]}).repartition(3))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(episode_index") == 1


def test_jumps(spark):
    f = frames_of(spark, {0: [0.0, 0.01, 0.01, float("nan"), 0.5], 1: [3], 2: [1, 0.5, 0.75]})
    d = windows.frame_deltas(f, (STATE,), (0,))
    ev = {(r.episode_index, r.frame_index): r.direction for r in windows.jump_events(d, 0.01).collect()}
    assert ev == {(0, 1): "open", (2, 1): "close", (2, 2): "open"}
    clean = frames_of(spark, {0: [0.0, 1.0, 0.5], 1: [0.0, -1.0], 2: [0, 0.25, 1.25]})
    s = windows.jump_summary(windows.frame_deltas(clean, (STATE,), (0,)), 0.5).first()
    deltas = np.array([1.0, -0.5, -1.0, 0.25, 1.0])
    assert (s.n, s.abs_max, s.abs_max_delta, s.abnormal_frames, s.abnormal_episodes, s.open_frames, s.close_frames) == (5, 1.0, 1.0, 4, 3, 2, 2)
    assert (s["mean"], s["std"], s.p95) == pytest.approx((deltas.mean(), deltas.std(), np.percentile(deltas, 95)))
    top = windows.top_jump_episodes(windows.frame_deltas(clean, (STATE,), (0,)), 2).orderBy("rank").collect()
    assert [r.episode_index for r in top] == [0, 1]


def test_timestamps(spark):
    grid = [round(i / 30, 5) for i in range(40)]
    jump = [x if i < 10 else x + 0.5 for i, x in enumerate(grid)]
    many = [i / 7 for i in range(12)]
    rows = [(e, i, float(t)) for e, ts in enumerate([grid, jump, many, [1.0]]) for i, t in enumerate(ts)]
    f = spark.createDataFrame(rows, "episode_index long, frame_index long, timestamp float")
    gaps = windows.timestamp_gaps(f, 30).collect()
    assert sorted((r.episode_index, r.frame_index) for r in gaps) == [(1, 10), *((2, i) for i in range(1, 6))]
    fixed = windows.fix_timestamps(f, 30)
    assert windows.timestamp_gaps(fixed, 30).count() == 0 and {r.timestamp for r in fixed.filter("episode_index = 3").collect()} == {1.0}
    assert windows.timestamp_gaps(windows.fix_timestamps(f, 30, episodes=[1]), 30).count() == 5


@pytest.mark.parametrize(
    "n,offset,found", [(60, None, 0), (61, None, 1), (100, (0, 0.151), 0), (100, (5, -0.151), 0), (100, (6, 0.011), 0), (100, (0, 0.149), 1)]
)
def test_pose_idle(spark, n, offset, found):
    pose = np.tile(np.array([*windows.TARGET_POSE, *([0.0] * 7)]), (n, 1))
    pose[:, 7:] = np.linspace(0, 1, n)[:, None]
    if offset:
        pose[:, offset[0]] += offset[1]
    got = windows.pose_idle_segments(frames_of(spark, {0: pose.tolist()}), 30).collect()
    assert [(r.start, r.end) for r in got] == [(0, n)] * found


def test_pose_blip_splits(spark):
    pose = np.tile(np.array([*windows.TARGET_POSE, *([0.0] * 7)]), (100, 1))
    pose[50, 0] += 0.002
    assert windows.pose_idle_segments(frames_of(spark, {0: pose.tolist()}), 30).count() == 0
    still = np.tile(pose[0], (70, 1))
    r = windows.pose_idle_episodes(frames_of(spark, {0: np.vstack([still, still + 1, still]).tolist()}), 30).first()
    assert (r.segments, r.start, r.end) == (2, 0, 70)


def test_stats_of_parts_are_stats_of_whole(spark):
    rng = np.random.default_rng(3)
    data = {e: rng.normal(size=(rng.integers(1, 9), 3)) for e in range(20)}
    s = stats.episode_stats(frames_of(spark, {e: x.tolist() for e, x in data.items()}), [STATE, "timestamp"])
    one = {r.episode_index: r.stats[STATE] for r in s.collect()}
    for e, x in data.items():
        for name, v in (("min", x.min(0)), ("max", x.max(0)), ("mean", x.mean(0)), ("std", x.std(0))):
            assert one[e][name] == pytest.approx(v.tolist())
    whole = np.vstack(list(data.values()))
    agg = sorted((r for r in stats.aggregate_stats(s).collect() if r.feature == STATE), key=lambda r: r.dim)
    assert [r["std"] for r in agg] == pytest.approx(whole.std(0).tolist()) and [r.n for r in agg] == [len(whole)] * 3
    assert stats.compare_stats(stats.aggregate_stats(s), stats.aggregate_stats(s)).count() == 0
    nan = stats.episode_stats(frames_of(spark, {0: [1.0, float("nan")]}), [STATE]).first().stats[STATE]
    assert math.isnan(nan["min"][0]) and math.isnan(nan["max"][0])


def test_mirror(spark):
    v = spark.createDataFrame([([float(i) for i in range(1, 15)],)], "v array<double>")
    assert v.select(mirror_vector(F.col("v"), (1, 4, 6)).alias("m")).first().m == [-8, 9, 10, -11, 12, -13, 14, -1, 2, 3, -4, 5, -6, 7]
    assert v.select(mirror_vector(F.col("v"), (1, 5, 6)).alias("m")).first().m == [-8, 9, 10, 11, -12, -13, 14, -1, 2, 3, 4, -5, -6, 7]
    for bad in ((6, 7), (), (1, 1), (7,)):
        with pytest.raises(ValueError):
            mirror_vector(F.col("v"), bad)
    with pytest.raises(Exception, match="14 numbers"):
        v.select(mirror_vector(F.slice("v", 1, 13), (1,)).alias("m")).collect()
    m = spark.createDataFrame(
        [([float(i) for i in range(1, 15)], [float(i) for i in range(101, 115)], [float(i) for i in range(21, 35)])],
        "lo array<double>, hi array<double>, sd array<double>"
    )
    out = augment.mirror_measures({"min": F.col("lo"), "max": F.col("hi"), "std": F.col("sd")}, (1, 4, 6))
    r = m.select(*(c.alias(k) for k, c in out.items())).first()
    assert r["min"][0] == -108 and r["max"][0] == -8 and r["std"] == [float(x) for x in [*range(28, 35), *range(21, 28)]]
    with pytest.raises(ValueError):
        augment.mirror_measures({"q01": F.col("lo")}, (1,))
    f = frames_of(spark, {0: [list(range(14)), list(range(14, 28))]}).withColumn(ACTION, col_(STATE))
    ds = Dataset.of_frames(f)
    twice = augment.mirror(augment.mirror(ds, (1, 2)), (1, 2))
    assert [r[STATE] for r in twice.frames.orderBy("frame_index").collect()] == [r[STATE] for r in f.orderBy("frame_index").collect()]
    assert augment.camera_map(["observation.images.hand_left"]) == {"observation.images.hand_left": "observation.images.hand_right"}
    for bad in (["x"], ["observation.images.hand_left", "x"], ["observation.images.hand_left", "observation.images.cam_high"]):
        with pytest.raises(ValueError):
            augment.camera_map(bad)
    merged = jobs.mirror_and_merge(ds, (1,))
    assert merged.frames.count() == 4 and jobs.decimate_and_merge(ds, 2).frames.count() == 3


def test_force_delta(spark):
    names = ["a", *transforms.FORCE_NAMES]
    f = frames_of(spark, {0: [[9, 1, 2, 3, 4, 5, 6], [8, 2, 2, 2, 2, 2, 2]]}).withColumn(ACTION, F.transform(col_(STATE), lambda x: x + 1))
    out = transforms.force_delta(f, names).orderBy("frame_index").collect()
    assert out[0][STATE] == [9, 0, 0, 0, 0, 0, 0] and out[1][STATE] == [8, 1, 0, -1, -2, -3, -4] and out[0][ACTION] == [10, 1, 1, 1, 1, 1, 1]
    assert transforms.force_violations(transforms.force_delta(f, names), names).count() == 0 and transforms.force_violations(f, names).count() == 1
    with pytest.raises(ValueError):
        transforms.force_delta(f, ["a"] * 7)


def test_rotation(spark):
    f = frames_of(spark, {0: [[1, 2, 3, 0, 0, 0, 1, 9], [1, 2, 3, 0, 0, 2, 0, 9], [0, 0, 0, 1, 1, 0, 0, 0]]})
    got = [r[STATE] for r in transforms.quat_state_to_rot6d(f, (0, 1, 2), (3, 4, 5, 6), 7).orderBy("frame_index").collect()]
    assert got[0] == pytest.approx([1, 2, 3, 1, 0, 0, 0, 1, 0, 9]) and got[1] == pytest.approx([1, 2, 3, -1, 0, 0, 0, -1, 0, 9]) and got[2] == pytest.approx(
        [0, 0, 0, 0, 1, 0, 1, 0, 0, 0], abs=1e-6
    )
    for bad in ([0] * 8, [0, 0, 0, float("inf"), 0, 0, 1, 0]):
        with pytest.raises(Exception, match="without a direction"):
            transforms.quat_state_to_rot6d(frames_of(spark, {0: [bad]}), (0, 1, 2), (3, 4, 5, 6), 7).collect()


def test_kinematics(spark):
    def arm_poses(joints, **options):
        df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(joints)], "i int, q array<double>")
        return np.array([tuple(r) for r in df.select("i", pose_of(df["q"], **options).alias("p")).orderBy("i").select("p.*").collect()])

    zero = arm_poses(np.zeros((1, 6)))[0]
    assert zero[:3] == pytest.approx([0.056128, 0, 0.213266], abs=1e-6) and np.degrees(zero[3:]) == pytest.approx([0, 85, 0], abs=1e-6)
    two = np.array([[0.1, 1, -0.7, 0.2, -0.3, 0.4], [-0.2, 2, -1.5, -0.4, 0.5, -0.6]])
    assert np.allclose(arm_poses(two), np.vstack([arm_poses(two[:1]), arm_poses(two[1:])]), atol=1e-12)
    moved = arm_poses(two, base_pose=(1, -2, 0.5, 0, 0, 0))
    assert np.allclose(moved[:, :3] - arm_poses(two)[:, :3], [1, -2, 0.5]) and np.allclose(moved[:, 3:], arm_poses(two)[:, 3:])
    for joint, pitch in ((5, 90), (-175, -90)):  # the tool upright: yaw is free and 0, and the roll shows how the base stands
        up = [np.degrees(arm_poses([[0.0, 0.0, 0.0, 0.0, np.radians(joint), 0.0]], base_pose=(0, 0, 0, 0, 0, turn))[0]) for turn in (0, 30)]
        assert up[0][3:] == pytest.approx([0, pitch, 0], abs=1e-9) and up[1][4:] == pytest.approx([pitch, 0], abs=1e-9)
        assert up[1][3] == pytest.approx(-30 if pitch > 0 else 30, abs=1e-9)
    with pytest.raises(Exception, match="six joint angles"):
        arm_poses(np.zeros((1, 7)))
    ds = Dataset.of_frames(frames_of(spark, {0: [[*two[0], 0, *two[1], 0]] * 3}))
    poses = occupancy.forward_kinematics(ds.frames).filter("frame_index = 0").orderBy("arm").collect()
    assert [poses[0].x, poses[0].pitch] == pytest.approx(
        [arm_poses(two[:1])[0][0], arm_poses(two[:1])[0][4]]
    ) and poses[1].y == pytest.approx(arm_poses(two[1:])[0][1] - 0.71)
    report = jobs.occupancy_report(ds)
    assert [r.n for r in report["voxels"].collect()] == [3, 3] and report["summary"].count() == 2 and report["top"].count() == 2


def test_profile(spark):
    f = frames_of(spark, {0: [[0, 0.1], [1, 4.0]], 1: [[1, float("nan")], [1, 0.2]]})
    d = {r.name: r for r in profile.dimension_summary(f, STATE, ["a", "b_joint"], 2).collect()}
    assert d["b_joint"].abnormal and not d["a"].abnormal and d["a"].maybe_discrete and d["b_joint"]["max"] == 4.0
    assert [r.episode_index for r in profile.out_of_range_episodes(f).collect()] == [0] and profile.out_of_range_share(f).first().percent == 50
    shares = {(r.dim, r.value): r.percent for r in profile.discrete_shares(f, STATE, 2, 3).collect()}
    assert shares == {(0, 0.0): 25.0, (0, 1.0): 75.0}
    assert profile.dimension_names(["x"], 2) == ["dim_0", "dim_1"] and [
        c for *_, c in profile.classify_dimensions(["left_a", "neck_joint", "q"])
    ] == ["Left Arm", "Trunk Joints", "Other"]
    x = np.random.default_rng(4).normal(size=900)
    h = profile.histogram(spark.createDataFrame([(0, float(v)) for v in x], "g int, x double"), "x", ["g"]).collect()
    want = np.histogram(x, 30)[0]
    assert {r.bin: r.n for r in h} == {i: n for i, n in enumerate(want.tolist()) if n}


def test_latency(spark):
    m = spark.createDataFrame(
        [("a", 2_000_000, 1_000_000), ("a", 5_000_000, 500_000), ("b", 9_000_000, 0), ("b", 4_000_000, None), ("b", 7_000_000, 3_000_000)],
        "topic string, log_ts_ns long, header_ts_ns long"
    )
    times = sorted((r.topic, round(r.time_s * 1e3, 6), r.latency_ms) for r in latency.topic_latency(m).collect())
    assert times == [("a", -0.5, 4.5), ("a", 0.0, 1.0), ("b", 2.0, 4.0)]
    s = {r.topic: r for r in latency.topic_latency_summary(m).collect()}
    assert s["a"]["median"] == 2.75 and s["b"].n == 1


def test_video_tables(spark):
    k = spark.createDataFrame(
        [("a", 0.0, 90), ("a", 1.0, 90), ("a", 1.5, 90), ("b", 0.0, 40), ("c", None, 10)], "path string, ts double, n_frames long"
    )
    g = {r.path: r for r in video.keyframe_gaps(k, 30).collect()}
    assert (g["a"].max_gap, g["a"].gop, g["a"].warn, g["b"].gop, g["b"].warn, g["c"].keyframes, g["c"].gop) == (1.0, 30, True, 40, True, 0, None)
    assert [r.path for r in video.worst_gaps(video.keyframe_gaps(k, 30), 2).collect()] == ["a", "b"]
    p = spark.createDataFrame([("top", "1", "h264", 30.0), ("top", "2", "h265", 30.0)], "video_key string, path string, codec string, fps double")
    f = {r.field: r for r in video.format_consistency(p, ["codec", "fps"], ["codec"]).collect()}
    assert (f["codec"].first, f["codec"].consistent, f["fps"].consistent, f["fps"]["mean"]) == ("h264", False, True, 30.0)


def test_glitches(spark):
    rng = np.random.default_rng(5)
    flat = np.full((32, 32), 0.5, np.float32)
    torn = flat.copy()
    torn[16:] = 0.95

    def score(now, before):
        return video.glitch_scores(now[None], None if before is None else before[None])[0]

    assert score(flat, flat) == 0 and score(torn, flat) > 0.7 and score(torn, torn) < score(torn, flat)
    assert 0 < score(torn, None) <= 0.45 and score(rng.random((4, 4)).astype("f4"), None) == 0
    noise = rng.random((9, 16, 12)).astype("f4")
    assert video.glitch_scores(noise[1:], noise[:-1]) == pytest.approx([score(a, b) for a, b in zip(noise[1:], noise[:-1])])
    seq = [flat, torn, flat, torn, flat]
    rows = [
        (0, "top", i, 32, 32, bytearray(x.tobytes()), None) for i, x in enumerate(seq)
    ] + [(1, "top", i, 32, 32, bytearray(flat.tobytes()), None) for i in range(3)] + [(2, "top", 0, 0, 0, None, "broken")]
    df = spark.createDataFrame(rows, "episode_index long, camera string, frame_index long, height int, width int, gray binary, error string")
    v = {r.episode_index: r for r in video.glitch_verdicts(video.score_frame_glitches(df)).collect()}
    assert v[0].abnormal and v[0].strong >= 2 and not v[1].abnormal and v[2].abnormal and v[1].checked == 3
    assert {r.frame_index for r in video.score_frame_glitches(df, 2).collect() if r.episode_index == 0} == {0, 2, 4}


def test_vector_guards_and_paths(spark):
    f = frames_of(spark, {0: [[1, 2], [1, float("inf")], [1, 3]]}).unionByName(frames_of(spark, {1: [[1]]}))
    assert {
        (r.episode_index, r.frame_index, r.rule) for r in validate.vector_violations(f, STATE).collect()
    } == {(0, 1, "not finite"), (1, 0, "width")}
    assert validate.vector_violations(f, STATE, dims=[0]).count() == 1
    df = spark.createDataFrame([(1234, "top")], "episode_index long, video_key string")
    path = df.select(format_path("v/c-{episode_chunk:03d}/{video_key}/e_{episode_index:06d}.mp4").alias("p")).first().p
    assert path == "v/c-001/top/e_001234.mp4"
    for bad in ("/abs", "a/../b", "{what}"):
        with pytest.raises(ValueError):
            format_path(bad)


def test_jump_and_force_jobs(spark):
    ds = range_dataset(spark)
    report = jobs.jump_report(ds, 0.01, dims=(0,))
    assert report["events"].count() == 0 and report["summary"].count() == 2
    v21, diff = jobs.to_v21(ds, stats.aggregate_stats(ds.stats))
    assert v21.info.codebase_version == "v2.1" and {r.feature for r in diff.collect()} == {ACTION}
    assert jobs.remove(ds, "0-2").info.total_episodes == 2 and jobs.remove_short(ds, 3).info.total_frames == 3
    with pytest.raises(ValueError):
        jobs.remove(ds, "0-9")


def test_quantiles_of_groups(spark):
    """Against numpy: ties, one value, nulls, a group with most rows, and edges that fall together."""
    rng = np.random.default_rng(11)
    groups = {
        "a": rng.normal(size=3000), "b": np.round(rng.normal(size=500), 1), "c": np.array([7.0]), "d": np.array([1.0] * 400 + [2.0]),
        "e": np.array([3.0, 1.0])
    }
    rows = [(g, 0, float(x)) for g, v in groups.items() for x in v] + [("a", 0, None), ("f", 0, None)]
    df = spark.createDataFrame(rows, "g string, h int, x double").repartition(5)
    probabilities = [0.0, 0.01, 0.25, 0.5, 0.95, 0.999, 1.0]
    for few in (True, False):
        got = {r.g: r.q for r in exact_quantiles(df, ["g", "h"], "x", probabilities, few).collect()}
        assert set(got) == set(groups) and all(got[g] == pytest.approx(np.quantile(v, probabilities)) for g, v in groups.items())
    whole = exact_quantiles(df, [], "x", [0.3]).first().q
    assert whole == pytest.approx(
        np.quantile(np.concatenate(list(groups.values())), [0.3])
    ) and exact_quantiles(df.limit(0), ["g"], "x", [0.5]).collect() == []


def test_split_and_norm_jobs(spark):
    f = frames_of(spark, {3: [[1]] * 5, 7: [[2]] * 4, 9: [[3]] * 3})
    ds = Dataset.of_frames(f)
    out = select.decimate_split(ds, 0.4, 2)
    got = [tuple(r) for r in out.frames.select("episode_index", "frame_index", "index").orderBy("index").collect()]
    assert got == [(0, 0, 0), (0, 1, 1), (0, 2, 2), *((1, i, 3 + i) for i in range(4)), *((2, i, 7 + i) for i in range(3))]
    assert [(r.episode_index, r.length) for r in out.episodes.orderBy("episode_index").collect()] == [(0, 3), (1, 4), (2, 3)]
    assert jobs.split_and_merge(ds, 0.4, 2).frames.count() == 22 and jobs.merge_many([ds, ds]).info.total_frames == 24
    assert jobs.trim_tails(ds, frames=2).info.total_frames == 6
    norms = jobs.norm_stats(frames_of(spark, {0: [[float(i), -float(i)] * 7 for i in range(101)]}), {STATE: 14})
    turned = augment.mirror_norm_stats(norms, (1,), [STATE]).first()
    assert turned.q01[:2] == pytest.approx([1, 1]) and turned.q99[:2] == pytest.approx([99, 99]) and turned["mean"][:2] == pytest.approx([50, 50])
    with pytest.raises(ValueError, match="come together"):
        augment.mirror_norm_stats(norms.drop("q99"), (1,), [STATE])


def test_layout_jobs_reject_what_does_not_fit(spark):
    ds = range_dataset(spark)
    files = validate.expected_files(ds).withColumn("length", F.lit(1))
    reference = DatasetInfo(robot_type="r")
    assert jobs.align(ds, reference, {}, "p", files).info.robot_type == "r"
    with pytest.raises(ValueError, match="files are missing"):
        jobs.align(ds, reference, {}, "p", files.limit(3))
    with pytest.raises(ValueError, match="don't fit"):
        jobs.to_v21(ds.with_(frames=ds.frames.filter("index <> 4")))


def test_a_table_is_read_once_for_each_use(spark, tmp_path):
    """Scans in the plans of jobs: splitting and merging don't multiply them."""
    f = frames_of(spark, {e: [[e]] * 4 for e in range(6)})
    f.write.parquet(str(tmp_path / "f"))
    ds = Dataset.of_frames(spark.read.parquet(str(tmp_path / "f")))

    def scans(df):
        return df._jdf.queryExecution().sparkPlan().toString().count("FileScan")

    assert scans(select.decimate_split(ds, 0.4, 2).frames) <= 5 and scans(merge.merge_datasets([ds, ds, ds]).frames) <= 9
    settled_name = str(tmp_path / "f")
    report = jobs.check_up(ds)._jdf.queryExecution().sparkPlan().toString()
    assert sum(settled_name in line for line in report.splitlines() if "FileScan" in line) <= 4
    assert scans(jobs.clean_idle(ds, info=False, widths={STATE: 1, ACTION: 0})[0].stats) <= 4


def test_pose_by_projections_equals_the_fold(spark):
    angles = np.random.default_rng(3).uniform(-3, 3, (40, 6)).tolist() + [[0.0, None, 0.0, 0.0, 0.0, 0.0]]
    rows = spark.createDataFrame([(i, q, "kept") for i, q in enumerate(angles)], "i int, q array<double>, _x0 string")  # a name of a step
    options = {"dh_offset": False, "tcp_offset": (0.0, 0.02, 0.1)}
    got = with_pose(rows, F.col("q"), base_column(RIGHT_BASE), ["i", "_x0"], **options)
    want = rows.select("i", "_x0", pose_of(F.col("q"), base_pose=RIGHT_BASE, **options).alias("p")).select("i", "_x0", "p.*")
    assert got.columns == want.columns
    got_rows, want_rows = ([tuple(r) for r in df.orderBy("i").collect()] for df in (got, want))
    assert got_rows[:-1] == want_rows[:-1]
    assert got_rows[-1][:2] == (40, "kept") and got_rows[-1][2] is None
    assert "aggregate(" not in got._jdf.queryExecution().executedPlan().toString()
