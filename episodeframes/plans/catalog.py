"""Registered queries and their SQL. Ids in names are those of the operator inventory; floats are rounded on both sides."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.vectors import doubles
from ..operators import augment, latency, merge, occupancy, profile, reindex, select, stats, tasks, transforms, validate, video, windows
from ..schema import ACTION, STATE, Dataset, DatasetInfo, col_
from ..sources.adapters import EMBEDDINGS_SQL, EVENTS_SQL, LINEITEM_SQL, MESSAGES_SQL, episodes_from_conversations, frames_from_embeddings, frames_from_events, frames_from_lineitem, messages_from_events, table

from . import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def r6(c: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: r6(n, digits) for n in names})


def events(spark, d, state: str = "s1") -> DataFrame:
    """Event frames with one state dimension."""
    f = frames_from_events(spark, d)
    return f if state == "all" else f.withColumn(STATE, F.array(col_(STATE)[int(state[1]) - 1])).withColumn(ACTION, F.array().cast("array<double>"))


def coarse(spark, d) -> DataFrame:
    return events(spark, d, "s2")


IDLE = dict(kind="state", eps=0.5, min_idle_len=3, min_nonidle_len=2)
W = "WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)"


def runs_sql(source: str, flag: str, out: str) -> str:
    return f"""{out} AS (
  SELECT *, count(*) OVER (PARTITION BY episode_index, run_{out}) AS n_{out} FROM (
    SELECT *, sum(CASE WHEN {flag} <> before_{out} THEN 1 ELSE 0 END) OVER (PARTITION BY episode_index ORDER BY frame_index) AS run_{out} FROM (
      SELECT *, lag({flag}) OVER w AS before_{out} FROM {source} {W})))"""


IDLE_SQL = f"""{EVENTS_SQL}, i AS (SELECT *, coalesce(abs(s2 - lag(s2) OVER w) < 0.5, false) AS idle, count(*) OVER (PARTITION BY episode_index) AS n
  FROM f {W}),
{runs_sql('i', 'idle', 'a')}, k AS (SELECT *, NOT (idle AND n_a >= 3) AS kept FROM a), {runs_sql('k', 'kept', 'b')},
g AS (SELECT *, n <= 1 OR (kept AND n_b >= 2) AS keep FROM b)"""


@query("j1_clean_idle_stats", f"""WITH {IDLE_SQL}, l AS (
  SELECT episode_index AS old_episode, count(*) AS length, min(s2) AS s_min, max(s2) AS s_max, round(avg(s2), 6) + 0.0 AS s_mean,
  round(stddev_pop(s2), 6) + 0.0 AS s_std FROM g WHERE keep GROUP BY ALL)
SELECT row_number() OVER (ORDER BY old_episode) - 1 AS episode_index, length,
  (sum(length) OVER (ORDER BY old_episode) - length)::BIGINT AS first_index, s_min, s_max, s_mean, s_std FROM l""")
def j1(spark, d):
    """Idle frames out, episodes and indices rebuilt, statistics of each new episode."""
    ds, _ = jobs.clean_idle(Dataset.of_frames(coarse(spark, d)), features=[STATE, "index"], widths={STATE: 1, "index": None}, info=False, **IDLE)
    s = F.col("stats")[STATE]
    out = ds.stats.select(
        "episode_index", s["count"][0].alias("length"), F.col("stats")["index"]["min"][0].cast("long").alias("first_index"),
        s["min"][0].alias("s_min"), s["max"][0].alias("s_max"), s["mean"][0].alias("s_mean"), s["std"][0].alias("s_std"),
    )
    return rounded(out, "s_mean", "s_std")


@query("e2_idle_ranges", f"""WITH {IDLE_SQL}, {runs_sql('g', 'keep', 'c')}
SELECT episode_index, min(frame_index) AS start, max(frame_index) + 1 AS "end" FROM c WHERE keep GROUP BY episode_index, run_c""")
def e2(spark, d):
    return windows.idle_ranges(coarse(spark, d), **IDLE)


@query("d18_filter_report", f"""WITH {IDLE_SQL} SELECT episode_index, count(*) AS before, count(*) FILTER (keep) AS after,
  count(*) FILTER (NOT keep) AS dropped,
  round(count(*) FILTER (NOT keep) / count(*), 6) + 0.0 AS ratio, count(*) FILTER (keep) = 0 AS skipped FROM g GROUP BY ALL""")
def d18(spark, d):
    return rounded(windows.filter_report(windows.idle_flags(coarse(spark, d), **IDLE)), "ratio")


@query("c12_apply_ranges", f"""WITH {IDLE_SQL} SELECT episode_index, count(*) AS n, sum(frame_index)::BIGINT AS places FROM g WHERE keep
  GROUP BY ALL""")
def c12(spark, d):
    frames = coarse(spark, d)
    kept = reindex.apply_ranges(frames, windows.idle_ranges(frames, **IDLE))
    return kept.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"), F.sum("frame_index").alias("places"))


@query("c12_overlapping_ranges", """SELECT l_orderkey AS episode_index, least(count(*), 3) + greatest(count(*) - 5, 0) AS n FROM lineitem
  GROUP BY l_orderkey""")
def c12_overlapping(spark, d):
    """Of every episode the first three frames, by ranges that overlap, and those from the sixth on; also empty ranges."""
    frames = frames_from_lineitem(spark, d)
    spans = F.explode(F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("end")) for a, b in ((0, 2), (1, 3), (0, 1), (4, 4), (5, 3), (5, 1000)))))
    ranges = frames.select("episode_index").distinct().select("episode_index", spans.alias("r")).select("episode_index", "r.*")
    return reindex.apply_ranges(frames, ranges).groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"))


DELTA_SQL = f"""{EVENTS_SQL}, d AS (SELECT episode_index, frame_index, lag(s1) OVER w AS prev, s1 AS curr, s1 - lag(s1) OVER w AS delta FROM f {W})"""
LIMIT = 80.0


def deltas(spark, d):
    return windows.frame_deltas(events(spark, d), signals=(STATE,), dims=(0,))


@query("e1_jump_events", f"""WITH {DELTA_SQL} SELECT episode_index, frame_index, prev, curr, round(delta, 6) + 0.0 AS delta,
  CASE WHEN delta > 0 THEN 'open' ELSE 'close' END AS direction
FROM d WHERE abs(delta) >= {LIMIT}""")
def e1(spark, d):
    return rounded(windows.jump_events(deltas(spark, d), LIMIT).select("episode_index", "frame_index", "prev", "curr", "delta", "direction"), "delta")


@query("d10_jump_summary", f"""WITH {DELTA_SQL} SELECT count(delta) AS n, round(avg(delta), 6) + 0.0 AS mean, round(stddev_pop(delta),
  6) + 0.0 AS std, round(min(delta), 6) AS min, round(max(delta), 6) AS max,
  round(quantile_cont(delta, 0.5), 6) + 0.0 AS p50, round(quantile_cont(delta, 0.95), 6) AS p95, round(quantile_cont(delta, 0.99), 6) AS p99,
  round(quantile_cont(delta, 0.999), 6) AS p999,
  round(max(abs(delta)), 6) AS abs_max, count(*) FILTER (abs(delta) >= {LIMIT}) AS abnormal_frames,
  count(DISTINCT episode_index) FILTER (abs(delta) >= {LIMIT}) AS abnormal_episodes,
  count(*) FILTER (delta >= {LIMIT}) AS open_frames, count(*) FILTER (delta <= -{LIMIT}) AS close_frames FROM d""")
def d10(spark, d):
    names = [
        "n", "mean", "std", "min", "max", "p50", "p95", "p99", "p999", "abs_max", "abnormal_frames", "abnormal_episodes", "open_frames",
        "close_frames"
    ]
    return rounded(windows.jump_summary(deltas(spark, d), LIMIT).select(*names), "mean", "std", "min", "max", "p50", "p95", "p99", "p999", "abs_max")


@query("e8_top_jump_episodes", f"""WITH {DELTA_SQL}, e AS (SELECT episode_index, max(abs(delta)) AS m, max(delta) FILTER (delta > 0) AS o,
  min(delta) FILTER (delta < 0) AS c FROM d GROUP BY ALL)
SELECT episode_index, round(m, 6) AS abs_max, round(o, 6) AS max_open, round(c, 6) AS max_close, row_number() OVER (ORDER BY m DESC,
  episode_index)::INT AS rank FROM e QUALIFY rank <= 5""")
def e8(spark, d):
    return rounded(
        windows.top_jump_episodes(deltas(spark, d), 5).select("episode_index", "abs_max", "max_open", "max_close", "rank"), "abs_max", "max_open",
        "max_close"
    )


@query("e4_timestamp_gaps", f"""WITH {EVENTS_SQL}, d AS (SELECT episode_index, frame_index,
  abs(timestamp::DOUBLE - lag(timestamp::DOUBLE) OVER w - 1000.0) AS off FROM f {W})
SELECT episode_index, frame_index, round(off, 3) + 0.0 AS off, row_number() OVER (PARTITION BY episode_index ORDER BY frame_index)::INT AS no FROM d
  WHERE off > 500 QUALIFY no <= 5""")
def e4(spark, d):
    return rounded(windows.timestamp_gaps(events(spark, d), 0.001, 500).select("episode_index", "frame_index", "off", "no"), "off", digits=3)


@query("e5_fix_timestamps", f"""WITH {EVENTS_SQL}, d AS (SELECT *, coalesce(abs(timestamp::DOUBLE - lag(timestamp::DOUBLE) OVER w - 1000.0) > 60000,
  false) AS bad FROM f {W}),
b AS (SELECT *, bool_or(bad) OVER (PARTITION BY episode_index) AS broken FROM d)
SELECT episode_index, bool_or(broken) AS broken, round(sum(CASE WHEN broken THEN frame_index * 1000.0 ELSE timestamp::DOUBLE END), 0) AS total FROM b
  GROUP BY ALL""")
def e5(spark, d):
    f = events(spark, d)
    fixed = windows.fix_timestamps(f.withColumn("was", F.col("timestamp")), 0.001, tol=60000)
    return fixed.groupBy("episode_index").agg(
        F.bool_or(F.col("was") != F.col("timestamp")).alias("broken"), F.round(F.sum(F.col("timestamp").cast("double")), 0).alias("total")
    )


def of_lineitem(spark, d) -> Dataset:
    return Dataset.of_frames(frames_from_lineitem(spark, d))


@query("c3_reindex", f"""WITH {LINEITEM_SQL}, l AS (SELECT episode_index AS o, count(*) AS n FROM f GROUP BY ALL), p AS (SELECT o,
  row_number() OVER (ORDER BY o) - 1 AS e, (sum(n) OVER (ORDER BY o) - n)::BIGINT AS place FROM l)
SELECT e AS episode_index, frame_index, place + frame_index AS index, s1 FROM f JOIN p ON o = episode_index""")
def c3(spark, d):
    return reindex.reindex(of_lineitem(spark, d)).frames.select("episode_index", "frame_index", "index", col_(STATE)[0].alias("s1"))


@query("c4_repaired_episodes", f"""WITH {LINEITEM_SQL}, l AS (SELECT o, row_number() OVER (ORDER BY o) - 1 AS e
  FROM (SELECT DISTINCT episode_index AS o FROM f))
SELECT e AS episode_index FROM l WHERE o <> e""")
def c4(spark, d):
    ds = of_lineitem(spark, d)
    placed = reindex.length_prefix(ds.episodes.select("episode_index", "length"))
    frames = ds.frames.join(
        placed.select("episode_index", "first_index"), "episode_index"
    ).withColumn("index", F.col("first_index") + F.col("frame_index")).drop("first_index")
    return reindex.repair_indices(ds.with_(frames=frames))[1]


STATS_SQL = "count(*) AS n, min({0}) AS min, max({0}) AS max, round(avg({0}), 6) + 0.0 AS mean, round(stddev_pop({0}), 6) + 0.0 AS std"


@query("d1_episode_stats", f"""WITH {LINEITEM_SQL} SELECT episode_index, '{STATE}' AS feature, 0 AS dim, {STATS_SQL.format('s1')} FROM f
  GROUP BY episode_index
UNION ALL SELECT episode_index, '{STATE}', 1, {STATS_SQL.format('s2')} FROM f GROUP BY episode_index
UNION ALL SELECT episode_index, '{ACTION}', 0, {STATS_SQL.format('a1')} FROM f GROUP BY episode_index UNION ALL SELECT episode_index, '{ACTION}', 1,
  {STATS_SQL.format('a2')} FROM f GROUP BY episode_index""")
def d1(spark, d):
    s = stats.episode_stats(frames_from_lineitem(spark, d), [STATE, ACTION], {STATE: 2, ACTION: 2})
    return rounded(stats.stats_rows(s), "mean", "std")


@query("d2_aggregate_stats", f"""WITH {LINEITEM_SQL} SELECT '{STATE}' AS feature, 0 AS dim, {STATS_SQL.format('s1')} FROM f UNION ALL SELECT '{STATE}', 1, count(*), min(s2), max(s2), round(avg(s2), 3), round(stddev_pop(s2), 3) FROM f""".replace(", 6) + 0.0", ", 3)"))
def d2(spark, d):
    s = stats.episode_stats(frames_from_lineitem(spark, d), [STATE], {STATE: 2})
    return rounded(stats.aggregate_stats(s), "mean", "std", digits=3)


@query("d1_ragged_stats", f"""WITH {EVENTS_SQL}, x AS (
  SELECT episode_index, frame_index, CASE frame_index % 4 WHEN 1 THEN [s1] WHEN 2 THEN [s1, s2] WHEN 3 THEN [s1, s2, s3] END AS v FROM f),
u AS (SELECT episode_index, unnest(range(len(v))) AS dim, unnest(v) AS x FROM x),
n AS (SELECT episode_index, count(*) AS n FROM f GROUP BY ALL)
SELECT u.episode_index, dim::INT AS dim, any_value(n) AS n, min(x) AS min, max(x) AS max, round(avg(x), 6) + 0.0 AS mean,
  round(stddev_pop(x), 6) + 0.0 AS std FROM u JOIN n ON n.episode_index = u.episode_index GROUP BY u.episode_index, dim""")
def d1_ragged(spark, d):
    """Vectors of one to three numbers in turn; the first frame of each episode, and every fourth after it, has none."""
    f, k = events(spark, d, "all"), F.col("frame_index") % 4
    f = f.withColumn(STATE, F.when(k > 0, F.slice(col_(STATE), F.lit(1), k.cast("int"))))
    s = stats.stats_rows(stats.episode_stats(f, [STATE]))
    return rounded(s.select("episode_index", "dim", "n", "min", "max", "mean", "std"), "mean", "std")


@query("d2_offset_stats", f"""WITH {LINEITEM_SQL}, e AS (
  SELECT episode_index, count(*) AS n, avg(s1 + 1e8) AS m, stddev_pop(s1 + 1e8) AS s, min(s1) AS low, max(s1) AS high FROM f GROUP BY ALL),
w AS (SELECT sum(n) AS n, sum(n * m) / sum(n) AS m FROM e)
SELECT 0 AS dim, any_value(w.n)::BIGINT AS n, min(low) + 1e8 AS min, max(high) + 1e8 AS max, round(any_value(w.m), 3) AS mean,
  round(sqrt(sum(e.n * (e.s * e.s + (e.m - w.m) ** 2)) / any_value(w.n)), 3) AS std FROM e, w""")
def d2_offset(spark, d):
    """Numbers of two digits above a hundred million, as global indices and clock times are."""
    f = frames_from_lineitem(spark, d).withColumn(STATE, F.array(col_(STATE)[0] + 1e8))
    out = stats.aggregate_stats(stats.episode_stats(f, [STATE])).select("dim", "n", "min", "max", "mean", "std")
    return rounded(out, "mean", "std", digits=3)


@query("d3_compare_stats", f"""WITH {LINEITEM_SQL} SELECT '{STATE}' AS feature, 0 AS dim, 'max' AS stat, max(s1) AS a, max(s1) + 1 AS b FROM f""")
def d3(spark, d):
    a = stats.aggregate_stats(stats.episode_stats(frames_from_lineitem(spark, d), [STATE], {STATE: 2}))
    return stats.compare_stats(a, a.withColumn("max", F.col("max") + F.when(F.col("dim") == 0, 1.0).otherwise(0.0)))


@query("d7_episode_lengths", f"""WITH {LINEITEM_SQL}, l AS (SELECT count(*) AS n FROM f GROUP BY episode_index)
SELECT count(*) AS episodes, min(n) AS min, max(n) AS max, quantile_cont(n, 0.25)::DOUBLE AS q25, quantile_cont(n, 0.5)::DOUBLE AS q50,
  quantile_cont(n, 0.75)::DOUBLE AS q75 FROM l""")
def d7(spark, d):
    return profile.episode_length_summary(of_lineitem(spark, d).episodes)


@query("d9_task_usage", f"""WITH {LINEITEM_SQL} SELECT task_index, count(*) AS frames, count(DISTINCT episode_index) AS episodes,
  round(count(*) / sum(count(*)) OVER (), 6) AS share, task_index <= 5 AS defined,
CASE WHEN task_index <= 5 THEN 'task ' || task_index END AS task FROM f GROUP BY task_index""")
def d9(spark, d):
    ds = of_lineitem(spark, d)
    return rounded(tasks.task_usage(ds.with_(tasks=ds.tasks.filter("task_index <= 5"))), "share")


def odd_tasks(spark, d) -> Dataset:
    """A tasks table that lacks numbers above 5 and has 99."""
    ds = of_lineitem(spark, d)
    return ds.with_(tasks=ds.tasks.filter("task_index <= 5").unionByName(spark.createDataFrame([(99, "unused")], "task_index long, task string")))


@query("c7_task_references", f"""WITH {LINEITEM_SQL} SELECT 'missing' AS kind, task_index, count(DISTINCT episode_index) AS episodes FROM f
  WHERE task_index > 5 GROUP BY task_index UNION ALL SELECT 'extra', 99, 0""")
def c7(spark, d):
    return tasks.task_reference_report(odd_tasks(spark, d))


@query("c8_unify_tasks", f"""WITH {LINEITEM_SQL}, t AS (SELECT 'task ' || min(task_index) AS task FROM f WHERE task_index <= 5)
SELECT episode_index, 0::BIGINT AS task_index, task, count(*) AS n FROM f, t GROUP BY episode_index, task""")
def c8(spark, d):
    ds = tasks.unify_tasks(odd_tasks(spark, d))
    return ds.frames.groupBy("episode_index", "task_index").agg(F.count(F.lit(1)).alias("n")).join(
        ds.episodes.select("episode_index", F.col("tasks")[0].alias("task")), "episode_index"
    )


@query("c9_fill_missing_tasks", f"""WITH {LINEITEM_SQL} SELECT DISTINCT task_index,
  CASE WHEN task_index <= 5 THEN 'task ' ELSE 'unknown task ' END || task_index AS task FROM f UNION ALL SELECT 99, 'unused'""")
def c9(spark, d):
    return tasks.fill_missing_tasks(odd_tasks(spark, d)).tasks


@query("c2_remap_tasks", f"""WITH {LINEITEM_SQL}, m AS (SELECT task_index, row_number() OVER (ORDER BY task_index) - 1 AS new
  FROM (SELECT DISTINCT task_index FROM f))
SELECT new AS task_index, 'task ' || f.task_index AS task, count(*) AS n FROM f JOIN m ON m.task_index = f.task_index GROUP BY ALL""")
def c2(spark, d):
    """All frames; the tasks table also has a number below and one above those that frames use."""
    ds = of_lineitem(spark, d)
    unused = spark.createDataFrame([(0, "unused"), (99, "never used")], "task_index long, task string")
    ds = tasks.remap_tasks(ds.with_(tasks=ds.tasks.unionByName(unused)))
    return ds.frames.groupBy("task_index").agg(F.count(F.lit(1)).alias("n")).join(ds.tasks, "task_index")


@query("b2_remove_episodes", f"""WITH {LINEITEM_SQL}, l AS (SELECT episode_index AS o, count(*) AS n, sum(s1) AS total FROM f
  WHERE episode_index NOT BETWEEN 10 AND 90 GROUP BY ALL)
SELECT row_number() OVER (ORDER BY o) - 1 AS episode_index, n, total FROM l""")
def b2(spark, d):
    ds = of_lineitem(spark, d)
    gone = select.parse_episode_selector("10-90", 1 << 30)
    out = select.remove_episodes(ds, gone)
    return out.frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"), F.sum(col_(STATE)[0]).alias("total"))


@query("b3_remove_short", f"""WITH {LINEITEM_SQL}, l AS (SELECT episode_index AS o, count(*) AS n FROM f GROUP BY ALL HAVING n >= 5)
SELECT row_number() OVER (ORDER BY o) - 1 AS episode_index, n AS length, (sum(n) OVER (ORDER BY o) - n)::BIGINT AS first_index FROM l""")
def b3(spark, d):
    out = select.remove_short_episodes(of_lineitem(spark, d), 5)
    return out.frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("length"), F.min("index").alias("first_index"))


@query("b4_extract_range", f"""WITH {EVENTS_SQL} SELECT episode_index - 20 AS episode_index, frame_index, row_number() OVER (ORDER BY episode_index,
  frame_index) - 1 AS index, s1 FROM f WHERE episode_index BETWEEN 20 AND 60""")
def b4(spark, d):
    ds = Dataset.of_frames(events(spark, d))
    return select.extract_episode_range(ds, 20, 60).frames.select("episode_index", "frame_index", "index", col_(STATE)[0].alias("s1"))


@query("b5_label_terminated", f"""WITH {EVENTS_SQL} SELECT episode_index, count(*) AS length, episode_index >= 100 AS terminated FROM f
  GROUP BY ALL""")
def b5(spark, d):
    return select.label_terminated(Dataset.of_frames(events(spark, d)).episodes, 100).select("episode_index", "length", "terminated")


@query("b7_trim_frames", f"""WITH {EVENTS_SQL}, t AS (SELECT *, count(*) OVER (PARTITION BY episode_index) AS n FROM f), k AS (SELECT * FROM t
  WHERE frame_index >= 3 AND frame_index < n - 30)
SELECT dense_rank() OVER (ORDER BY episode_index) - 1 AS episode_index, frame_index - 3 AS frame_index, round(((frame_index - 3)::FLOAT)::DOUBLE / 30,
  5) AS timestamp, s1 FROM k""")
def b7(spark, d):
    out = select.trim_frames(Dataset.of_frames(events(spark, d)), 3, tail_s=1.0, on_short="drop")
    return out.frames.select(
        "episode_index", "frame_index", F.round(F.col("timestamp").cast("double"), 5).alias("timestamp"), col_(STATE)[0].alias("s1")
    )


@query("b8_decimate", f"""WITH {LINEITEM_SQL} SELECT dense_rank() OVER (ORDER BY episode_index) - 1 AS episode_index, frame_index // 3 AS frame_index,
  row_number() OVER (ORDER BY episode_index, frame_index) - 1 AS index, s1 FROM f WHERE frame_index % 3 = 0""")
def b8(spark, d):
    return select.decimate(of_lineitem(spark, d), 3).frames.select("episode_index", "frame_index", "index", col_(STATE)[0].alias("s1"))


@query("b9_decimate_split", f"""WITH {EVENTS_SQL}, n AS (SELECT greatest(1, floor(count(DISTINCT episode_index) * 0.4)) AS n FROM f), o AS (SELECT *,
  dense_rank() OVER (ORDER BY episode_index) AS e FROM f),
k AS (SELECT e, CASE WHEN e <= n THEN frame_index // 2 ELSE frame_index END AS frame_index, s1 FROM o, n WHERE e > n OR frame_index % 2 = 0)
SELECT e - 1 AS episode_index, frame_index, row_number() OVER (ORDER BY e, frame_index) - 1 AS index, s1 FROM k""")
def b9(spark, d):
    return select.decimate_split(Dataset.of_frames(events(spark, d)), 0.4, 2).frames.select(
        "episode_index", "frame_index", "index", col_(STATE)[0].alias("s1")
    )


@query("b10_head_episodes", f"""WITH {LINEITEM_SQL}, h AS (SELECT DISTINCT episode_index FROM f ORDER BY 1 LIMIT 25) SELECT episode_index,
  count(*) AS n FROM f WHERE episode_index IN (SELECT episode_index FROM h) GROUP BY ALL""")
def b10(spark, d):
    return select.head_episodes(of_lineitem(spark, d), 25).frames.groupBy("episode_index").agg(F.count(F.lit(1)).alias("n"))


@query("b12_even_sample", f"""WITH {EVENTS_SQL}, t AS (SELECT *, count(*) OVER (PARTITION BY episode_index) AS n FROM f)
SELECT episode_index, frame_index, s1 FROM t WHERE list_contains(list_transform(range(7), lambda i: floor(i * ((n - 1) / 6))::BIGINT),
  frame_index)""")
def b12(spark, d):
    return select.evenly_sample(events(spark, d), 7, ["frame_index"], truncate=True).select(
        "episode_index", "frame_index", col_(STATE)[0].alias("s1")
    )


@query("b12_even_sample_whole", f"""WITH {LINEITEM_SQL}, o AS (SELECT *, row_number() OVER (ORDER BY episode_index, frame_index) - 1 AS place,
  count(*) OVER () AS n FROM f), p AS (SELECT DISTINCT round_even(i * ((n - 1) / 14999), 0)::BIGINT AS place
  FROM (SELECT unnest(range(15000)) AS i), (SELECT count(*) AS n FROM f))
SELECT episode_index, frame_index, s1 FROM o WHERE place IN (SELECT place FROM p)""")
def b12_whole(spark, d):
    """15,000 frames spread over the whole table."""
    out = select.evenly_sample(frames_from_lineitem(spark, d), 15_000, ["episode_index", "frame_index"], partition_by=())
    return out.select("episode_index", "frame_index", col_(STATE)[0].alias("s1"))


@query("b14_episode_view", f"""WITH {EVENTS_SQL} SELECT episode_index, frame_index, s1 AS a1, s2 FROM f WHERE episode_index = 7""")
def b14(spark, d):
    ds = Dataset.of_frames(frames_from_events(spark, d))
    view = select.episode_view(ds, 7)
    return view.select(
        "episode_index", (F.row_number().over(Window.partitionBy("episode_index").orderBy("timestamp")) - 1).cast("long").alias("frame_index"),
        F.col(ACTION)[0].alias("a1"), col_(STATE)[1].alias("s2")
    )


@query("c5_merge", f"""WITH {LINEITEM_SQL}, u AS (SELECT * FROM (SELECT unnest([0, 1, 2]) AS k), f), e AS (SELECT *, dense_rank() OVER (ORDER BY k,
  episode_index) - 1 AS e FROM u)
SELECT e AS episode_index, count(*) AS n, min(i) AS first_index, sum(s1) AS total FROM (SELECT *, row_number() OVER (ORDER BY e, frame_index) - 1 AS i
  FROM e) GROUP BY e""")
def c5(spark, d):
    ds = of_lineitem(spark, d)
    out = merge.merge_datasets([ds, ds, ds])
    return out.frames.groupBy("episode_index").agg(
        F.count(F.lit(1)).alias("n"), F.min("index").alias("first_index"), F.sum(col_(STATE)[0]).alias("total")
    )


MIRROR = (1, 4, 6)


def pick(name: str, dims) -> list[Column]:
    return [r6(col_(name)[i]).alias(f"x{i}") for i in dims]


@query("f1_mirror", f"""WITH {EMBEDDINGS_SQL} SELECT index, round(-state[8], 6) + 0.0 AS x0, round(state[9], 6) + 0.0 AS x1, round(-state[11],
  6) + 0.0 AS x3, round(state[14], 6) + 0.0 AS x6, round(-state[1], 6) + 0.0 AS x7, round(-state[6], 6) + 0.0 AS x12, round(state[7], 6) + 0.0 AS x13
  FROM f""")
def f1(spark, d):
    ds = augment.mirror(Dataset.of_frames(frames_from_embeddings(spark, d)), MIRROR)
    return ds.frames.select("index", *pick(STATE, (0, 1, 3, 6, 7, 12, 13)))


@query("f2_mirror_stats", f"""WITH {EMBEDDINGS_SQL} SELECT episode_index, round(min(-state[8]), 6) + 0.0 AS low0, round(max(-state[8]),
  6) + 0.0 AS high0, round(min(state[9]), 6) + 0.0 AS low1, round(avg(-state[1]), 6) + 0.0 AS mean7, round(stddev_pop(state[1]), 6) + 0.0 AS std7
  FROM f GROUP BY ALL""")
def f2(spark, d):
    s = augment.mirror_stats(stats.episode_stats(frames_from_embeddings(spark, d), [STATE], {STATE: 14}), MIRROR, [STATE])
    m = F.col("stats")[STATE]
    return s.select(
        "episode_index", r6(m["min"][0]).alias("low0"), r6(m["max"][0]).alias("high0"), r6(m["min"][1]).alias("low1"),
        r6(m["mean"][7]).alias("mean7"), r6(m["std"][7]).alias("std7")
    )


FORCES = [f"d{i}" for i in range(8)] + list(transforms.FORCE_NAMES)


@query("f4_force_delta", f"""WITH {EMBEDDINGS_SQL}, b AS (SELECT *, first_value(state) OVER w AS base FROM f {W})
SELECT index, round(state[8], 5) + 0.0 AS kept, round(state[9] - base[9], 5) + 0.0 AS s_x, round(action[14] - base[14], 5) + 0.0 AS a_z FROM b""")
def f4(spark, d):
    f = transforms.force_delta(frames_from_embeddings(spark, d), FORCES)
    return f.select("index", *(r6(col_(c)[i].cast("double"), 5).alias(n) for c, i, n in ((STATE, 7, "kept"), (STATE, 8, "s_x"), (ACTION, 13, "a_z"))))


@query("f5_rotation_state", f"""WITH {EMBEDDINGS_SQL}, q AS (SELECT index, state, sqrt(state[4]**2 + state[5]**2 + state[6]**2 + state[7]**2) AS n
  FROM f)
SELECT index, round(state[1], 4) + 0.0 AS x, round(1 - 2 * ((state[5] / n)**2 + (state[6] / n)**2), 4) + 0.0 AS r0,
  round(2 * (state[4] * state[5] + state[6] * state[7]) / (n * n), 4) + 0.0 AS r1, round(2 * (state[5] * state[6] + state[4] * state[7]) / (n * n),
  4) + 0.0 AS r5, round(state[8], 4) + 0.0 AS grip FROM q""")
def f5(spark, d):
    f = transforms.quat_state_to_rot6d(frames_from_embeddings(spark, d), (0, 1, 2), (3, 4, 5, 6), 7)
    return f.select("index", *(r6(col_(STATE)[i].cast("double"), 4).alias(n) for i, n in ((0, "x"), (3, "r0"), (4, "r1"), (8, "r5"), (9, "grip"))))


@query("f6_forward_kinematics")
def f6(spark, d):
    return rounded(occupancy.forward_kinematics(frames_from_embeddings(spark, d)).drop("timestamp"), "x", "y", "z", "roll", "pitch", "yaw")


def positions(spark, d) -> DataFrame:
    """Positions for both arms straight from the vectors (no kinematics), so that SQL can follow."""
    f = frames_from_embeddings(spark, d)
    arms = [
        f.select("episode_index", "frame_index", F.lit(a).alias("arm"), *(F.round(doubles(n)[i], 5).alias(c) for i, c in enumerate("xyz"))) for a,
        n in (("left", STATE), ("right", ACTION))
    ]
    return arms[0].unionByName(arms[1])


POSITIONS_SQL = f"""{EMBEDDINGS_SQL}, p AS (SELECT 'left' AS arm, round(state[1], 5) AS x, round(state[2], 5) AS y, round(state[3], 5) AS z FROM f
  UNION ALL SELECT 'right', round(action[1], 5), round(action[2], 5), round(action[3], 5) FROM f),
v AS (SELECT arm, floor(x / 0.125)::BIGINT AS ix, floor(y / 0.125)::BIGINT AS iy, floor(z / 0.125)::BIGINT AS iz, count(*) AS n FROM p
  GROUP BY ALL)"""


@query("d13_voxels", f"WITH {POSITIONS_SQL} SELECT *, (ix + 0.5) * 0.125 AS cx, (iy + 0.5) * 0.125 AS cy, (iz + 0.5) * 0.125 AS cz FROM v")
def d13(spark, d):
    return occupancy.voxelize(positions(spark, d), 0.125)


@query("d14_top_voxels", f"""WITH {POSITIONS_SQL} SELECT arm, ix, iy, iz, n, round(100 * n / sum(n) OVER (PARTITION BY arm), 6) AS percent,
  round(n / 30, 6) AS dwell_s, row_number() OVER (PARTITION BY arm ORDER BY n DESC, ix, iy, iz)::INT AS rank FROM v QUALIFY rank <= 20""")
def d14(spark, d):
    return rounded(occupancy.top_voxels(occupancy.voxelize(positions(spark, d), 0.125), 20).drop("cx", "cy", "cz"), "percent", "dwell_s")


@query("d15_position_summary", f"""WITH {POSITIONS_SQL}, c AS (SELECT arm, count(*) AS voxels, max(n) AS busiest_n FROM v GROUP BY arm)
SELECT p.arm, count(*) AS valid, 0::BIGINT AS invalid, round(min(x), 5) AS x_min, round(max(y), 5) AS y_max, round(avg(z), 5) + 0.0 AS z_mean,
  round(stddev_pop(x), 5) AS x_std, round(quantile_cont(y, 0.05), 5) + 0.0 AS y_p05, any_value(voxels) AS voxels, any_value(busiest_n) AS busiest_n
FROM p JOIN c ON c.arm = p.arm GROUP BY p.arm""")
def d15(spark, d):
    p = positions(spark, d)
    out = occupancy.position_summary(p, occupancy.voxelize(p, 0.125)).select(
        "arm", "valid", "invalid", "x_min", "y_max", "z_mean", "x_std", "y_p05", "voxels", "busiest_n"
    )
    return rounded(out, "x_min", "y_max", "z_mean", "x_std", "y_p05", digits=5)


@query("d16_plane_density", f"""WITH {POSITIONS_SQL}, e AS (SELECT floor(min(x) / 0.125) AS x0, floor(min(y) / 0.125) AS y0,
  floor(min(z) / 0.125) AS z0, ceil(max(x) / 0.125) AS x1, ceil(max(y) / 0.125) AS y1, ceil(max(z) / 0.125) AS z1 FROM p),
b AS (SELECT arm, least(floor((x - x0 * 0.125) / 0.125), x1 - x0 - 1)::BIGINT AS bx, least(floor((y - y0 * 0.125) / 0.125),
  y1 - y0 - 1)::BIGINT AS y_, least(floor((z - z0 * 0.125) / 0.125), z1 - z0 - 1)::BIGINT AS z_ FROM p, e)
SELECT arm, 'XY' AS plane, bx, y_ AS by, count(*) AS n FROM b GROUP BY ALL UNION ALL SELECT arm, 'XZ', bx, z_, count(*) FROM b GROUP BY ALL UNION ALL
  SELECT arm, 'YZ', y_, z_, count(*) FROM b GROUP BY ALL""")
def d16(spark, d):
    return occupancy.plane_density(positions(spark, d), 0.125)


@query("d12_topic_latency", f"""WITH {MESSAGES_SQL}, v AS (SELECT * FROM m WHERE header_ts_ns <> 0), s AS (SELECT min(h) AS start
  FROM (SELECT arg_min(header_ts_ns, log_ts_ns) AS h FROM v GROUP BY topic))
SELECT topic, count(*) AS n, round(quantile_cont((log_ts_ns - header_ts_ns) / 1e6, 0.5), 4) AS median, round(avg((log_ts_ns - header_ts_ns) / 1e6),
  4) AS mean, round(stddev_pop((log_ts_ns - header_ts_ns) / 1e6), 4) AS std, round(min((log_ts_ns - header_ts_ns) / 1e6), 4) AS min,
  round(max((log_ts_ns - header_ts_ns) / 1e6), 4) AS max, 'other' AS kind FROM v GROUP BY topic""")
def d12(spark, d):
    return rounded(latency.topic_latency_summary(messages_from_events(spark, d)), "median", "mean", "std", "min", "max", digits=4)


@query("d12_topic_times", f"""WITH {MESSAGES_SQL}, v AS (SELECT * FROM m WHERE header_ts_ns <> 0), s AS (SELECT min(h) AS start
  FROM (SELECT arg_min(header_ts_ns, log_ts_ns) AS h FROM v GROUP BY topic))
SELECT topic, round(min((header_ts_ns - start) / 1e9), 3) + 0.0 AS first_s, round(max((header_ts_ns - start) / 1e9), 3) AS last_s FROM v, s
  GROUP BY topic""")
def d12t(spark, d):
    return rounded(
        latency.topic_latency(messages_from_events(spark, d)).groupBy("topic").agg(F.min("time_s").alias("first_s"), F.max("time_s").alias("last_s")),
        "first_s", "last_s", digits=3
    )


@query("d4_dimension_summary", f"""WITH {EMBEDDINGS_SQL}, x AS (SELECT unnest(range(14)) AS dim, unnest(state) AS v FROM f)
SELECT dim::INT AS dim, 'j' || dim || '_joint' AS name, count(*) AS n, round(min(v), 6) AS min, round(max(v), 6) AS max, round(quantile_cont(v, 0.25),
  6) + 0.0 AS q25, round(quantile_cont(v, 0.5), 6) + 0.0 AS q50, round(quantile_cont(v, 0.75), 6) + 0.0 AS q75, round(degrees(max(v)), 4) AS max_deg,
  bool_or(abs(v) > 0.4) AS abnormal FROM x GROUP BY dim""")
def d4(spark, d):
    out = profile.dimension_summary(frames_from_embeddings(spark, d), STATE, [f"j{i}_joint" for i in range(14)], 14, limit=0.4)
    return rounded(
        rounded(out.select("dim", "name", "n", "min", "max", "q25", "q50", "q75", "max_deg", "abnormal"), "min", "max", "q25", "q50", "q75"),
        "max_deg", digits=4
    )


@query("d4_discrete_flags", f"""WITH {LINEITEM_SQL}, x AS (SELECT 0 AS dim, floor(s1 / 11) AS v FROM f UNION ALL SELECT 1, floor(s1 / 10) FROM f
  UNION ALL SELECT 2, s2 FROM f)
SELECT dim, 'dim_' || dim AS name, count(*) AS n, count(DISTINCT v) <= 5 AS discrete FROM x GROUP BY dim
UNION ALL SELECT -1, 'skipped: widths from 1 to 2', 0, false""")
def d4_flags(spark, d):
    """Dimensions of five and of six values, and one of many; then a feature of two widths."""
    f = frames_from_lineitem(spark, d)
    even = f.withColumn(STATE, F.array(F.floor(col_(STATE)[0] / 11).cast("double"), F.floor(col_(STATE)[0] / 10).cast("double"), col_(STATE)[1]))
    odd = f.withColumn(STATE, F.slice(col_(STATE), F.lit(1), F.when(F.col("frame_index") == 0, 1).otherwise(2)))
    both = [profile.dimension_summary(x, STATE, [], n) for x, n in ((even, 3), (odd, 2))]
    return both[0].unionByName(both[1]).select("dim", "name", "n", "discrete")


@query("d5_discrete_shares", f"""WITH {LINEITEM_SQL}, x AS (SELECT 0 AS dim, floor(s1 / 10) AS v FROM f UNION ALL SELECT 1, s2 FROM f),
  g AS (SELECT dim, v AS value, count(*) AS n FROM x GROUP BY ALL)
SELECT dim, value, n, round(100 * n / sum(n) OVER (PARTITION BY dim), 6) AS percent FROM g QUALIFY count(*) OVER (PARTITION BY dim) <= 6""")
def d5(spark, d):
    f = frames_from_lineitem(spark, d)
    f = f.withColumn(STATE, F.array(F.floor(col_(STATE)[0] / 10).cast("double"), col_(STATE)[1]))
    return rounded(profile.discrete_shares(f, STATE, 2, 6), "percent")


@query("d6_out_of_range_episodes", f"""WITH {EMBEDDINGS_SQL} SELECT DISTINCT episode_index FROM f WHERE len(list_filter(list_concat(state, action),
  lambda x: abs(x) > 0.42)) > 0""")
def d6(spark, d):
    return profile.out_of_range_episodes(frames_from_embeddings(spark, d), 0.42)


@query("d8_dimension_categories", f"""WITH {EMBEDDINGS_SQL}, x AS (SELECT unnest(range(14)) AS dim, unnest(state) AS v FROM f)
SELECT CASE WHEN dim < 5 THEN 'Left Arm' WHEN dim < 10 THEN 'Right Arm' WHEN dim = 10 THEN 'Trunk Joints' ELSE 'Other' END AS category, count(*) AS n,
  round(max(v), 6) AS max FROM x GROUP BY ALL""")
def d8(spark, d):
    names = [f"left_{i}" for i in range(5)] + [f"right_{i}" for i in range(5)] + ["neck_joint", "a", "b", "c"]
    kinds = spark.createDataFrame(profile.classify_dimensions(names), "dim int, name string, category string")
    s = profile.dimension_summary(frames_from_embeddings(spark, d), STATE, names, 14).select("dim", "n", "max")
    return rounded(s.join(F.broadcast(kinds), "dim").groupBy("category").agg(F.sum("n").alias("n"), F.max("max").alias("max")), "max")


@query("d11_histogram", f"""WITH {EVENTS_SQL}, e AS (SELECT task_index, min(s1) AS low, max(s1) AS high, least(120, greatest(20,
  floor(sqrt(count(*)))))::INT AS bins FROM f GROUP BY ALL)
SELECT f.task_index, least(floor((s1 - low) / ((high - low) / bins)), bins - 1)::INT AS bin, count(*) AS n FROM f
  JOIN e ON e.task_index = f.task_index GROUP BY ALL""")
def d11(spark, d):
    f = events(spark, d).select("task_index", col_(STATE)[0].alias("s1"))
    return profile.histogram(f, "s1", ["task_index"]).select("task_index", "bin", "n")


@query("e3_pose_idle", f"""WITH {EMBEDDINGS_SQL}, i AS (SELECT episode_index, frame_index, len(list_filter(state[1:7], lambda x: abs(x) > 0.2)) = 0
  AND (frame_index = 0 OR len(list_filter(list_zip(state[1:7], lag(state[1:7]) OVER w), lambda z: abs(z[1] - z[2]) > 0.35)) = 0) AS idle FROM f {W}),
{runs_sql('i', 'idle', 'a')}, s AS (SELECT episode_index, min(frame_index) AS start, max(frame_index) + 1 AS stop FROM a WHERE idle
  GROUP BY episode_index, run_a)
SELECT episode_index, count(*) AS segments, arg_min(start, (start - stop) * 1000 + start) AS start, arg_min(stop,
  (start - stop) * 1000 + start) AS "end" FROM s WHERE (stop - start) / 10 > 0.1 GROUP BY ALL""")
def e3(spark, d):
    return windows.pose_idle_episodes(
        frames_from_embeddings(spark, d), fps=10, min_s=0.1, target=(0.0,) * 7, joint_tol=0.2, gripper_tol=0.2, still_tol=0.35
    ).select("episode_index", "segments", "start", "end")


@query("e6_index_violations", """WITH t AS (SELECT conv_id AS episode_index, turn + (turn >= 1 AND conv_id % 3 = 0)::INT AS frame_index,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS place FROM conversations)
SELECT episode_index, frame_index, 'frame_index' AS rule FROM t WHERE frame_index <> place""")
def e6(spark, d):
    """All turns; in every third conversation all turns but the first are numbered one too high."""
    late = ((F.col("frame_index") >= 1) & (F.col("episode_index") % 3 == 0)).cast("int")
    f = episodes_from_conversations(spark, d).withColumn("frame_index", F.col("frame_index") + late).withColumn("task_index", F.lit(0).cast("long"))
    return validate.index_violations(Dataset.of_frames(f))


@query("e7_metadata_violations", """WITH c AS (SELECT DISTINCT conv_id + conv_id // 5 AS e FROM conversations) SELECT 'episodes' AS "table", e AS key,
  'gap' AS rule FROM c WHERE e <> 0 AND e - 1 NOT IN (SELECT e FROM c)""")
def e7(spark, d):
    """All conversations; their numbers are spread so that every sixth one is left out."""
    spread = F.expr("episode_index + episode_index div 5")
    f = episodes_from_conversations(spark, d).withColumn("episode_index", spread).withColumn("task_index", F.lit(0).cast("long"))
    return validate.metadata_violations(Dataset.of_frames(f))


@query("f7_vector_violations", f"""WITH {EVENTS_SQL} SELECT episode_index, frame_index,
  CASE WHEN frame_index % 50 = 0 THEN 'null' WHEN frame_index % 50 = 1 THEN 'width' ELSE 'not finite' END AS rule FROM f
  WHERE frame_index % 50 <= 2""")
def f7(spark, d):
    f = events(spark, d, "all")
    k = F.col("frame_index") % 50
    odd = F.when(k == 0, None).when(k == 1, F.slice(col_(STATE), 1, 2)).when(
        k == 2, F.array(F.lit(0.0), F.lit(float("nan")), F.lit(1.0))
    ).otherwise(col_(STATE))
    return validate.vector_violations(f.withColumn(STATE, odd), STATE)


@query("c10_missing_files", """WITH e AS (SELECT DISTINCT conv_id AS e FROM conversations), p AS (SELECT e,
  printf('data/chunk-%03d/episode_%06d.parquet', e // 10, e) AS path, 'data' AS kind FROM e UNION ALL SELECT e,
  printf('videos/chunk-%03d/top/episode_%06d.mp4', e // 10, e), 'video' FROM e)
SELECT path, kind, CASE WHEN e % 7 = 0 THEN 'missing' ELSE 'empty' END AS problem FROM p WHERE e % 7 = 0 OR e % 11 = 0""")
def c10(spark, d):
    f = episodes_from_conversations(spark, d).withColumn("task_index", F.lit(0).cast("long"))
    ds = Dataset.of_frames(f, info=DatasetInfo(chunks_size=10, features={"top": {"dtype": "video"}}))
    n = F.regexp_extract("path", r"episode_(\d+)", 1).cast("long")
    inventory = validate.expected_files(ds).filter(n % 7 != 0).select("path", F.when(n % 11 == 0, 0).otherwise(9).alias("length"))
    return validate.missing_files(ds, inventory)


@query("c11_length_reconciliation", f"""WITH {LINEITEM_SQL}, l AS (SELECT episode_index, count(*) AS n FROM f GROUP BY ALL)
SELECT episode_index, CASE WHEN episode_index % 50 <> 1 THEN n ELSE -1 END AS rows,
  CASE WHEN episode_index % 50 <> 2 THEN n + (episode_index % 50 = 3)::BIGINT ELSE -1 END AS length,
 
  CASE WHEN episode_index % 50 = 1 THEN 'no_frames' WHEN episode_index % 50 = 2 THEN 'no_metadata' WHEN episode_index % 50 = 3 THEN 'length' ELSE 'short' END AS problem FROM l WHERE episode_index % 50 IN (1, 2, 3) OR n < 2""")
def c11(spark, d):
    ds = of_lineitem(spark, d)
    k = F.col("episode_index") % 50
    episodes = ds.episodes.filter(k != 2).withColumn("length", F.col("length") + F.when(k == 3, 1).otherwise(0))
    return validate.length_reconciliation(ds.with_(frames=ds.frames.filter(k != 1), episodes=episodes)).fillna(-1, ["rows", "length"])


@query("c1_renumber_episodes", f"""WITH {LINEITEM_SQL}, l AS (SELECT o, row_number() OVER (ORDER BY o) - 1 AS e
  FROM (SELECT DISTINCT episode_index AS o FROM f))
SELECT e AS episode_index, frame_index, s1 FROM f JOIN l ON o = episode_index""")
def c1(spark, d):
    ds = reindex.renumber_episodes(of_lineitem(spark, d))
    return ds.frames.select("episode_index", "frame_index", col_(STATE)[0].alias("s1"))


@query("c6_select_with_tasks", f"""WITH {EVENTS_SQL}, e AS (SELECT episode_index, list_sort(list(DISTINCT task_index)) AS t FROM f
  WHERE episode_index IN (3, 5, 8) GROUP BY ALL)
SELECT row_number() OVER (ORDER BY episode_index) - 1 AS episode_index, array_to_string(list_transform(t, lambda x: 'task ' || x), ',') ||
  CASE WHEN episode_index = 5 THEN ',new task' ELSE '' END AS tasks FROM e""")
def c6(spark, d):
    out = select.select_episodes(Dataset.of_frames(events(spark, d)), [3, 5, 8], {5: "new task"})
    return out.episodes.select("episode_index", F.array_join("tasks", ",").alias("tasks"))


@query("b6_rename_features", f"""WITH {EMBEDDINGS_SQL} SELECT episode_index, 'state' AS feature, round(max(state[1]), 6) AS max FROM f
  GROUP BY episode_index UNION ALL SELECT episode_index, '{ACTION}', round(max(action[1]), 6) FROM f GROUP BY episode_index""")
def b6(spark, d):
    f = frames_from_embeddings(spark, d)
    ds = Dataset.of_frames(f).with_(stats=stats.episode_stats(f, [STATE, ACTION], {STATE: 14, ACTION: 14}))
    return rounded(
        stats.stats_rows(select.rename_features(ds, {STATE: "state"}).stats).filter("dim = 0").select("episode_index", "feature", "max"), "max"
    )


@query("b11_drop_features", f"""WITH {EMBEDDINGS_SQL} SELECT index, task_index, round(state[14], 6) + 0.0 AS last FROM f""")
def b11(spark, d):
    ds = select.drop_features(Dataset.of_frames(frames_from_embeddings(spark, d)), [ACTION, "timestamp"])
    return ds.frames.select("index", "task_index", r6(F.element_at(col_(STATE), -1)).alias("last"))


@query("b13_align", f"""WITH {EMBEDDINGS_SQL} SELECT episode_index, 'one task' AS tasks, 0::BIGINT AS task_index, count(*) AS length FROM f
  GROUP BY ALL""")
def b13(spark, d):
    ds = select.align_to(Dataset.of_frames(frames_from_embeddings(spark, d)), DatasetInfo(robot_type="r"), {}, "one task")
    return ds.episodes.select("episode_index", F.array_join("tasks", ",").alias("tasks"), "task_index", "length")


@query("d17_totals", f"""WITH {LINEITEM_SQL}, t AS (SELECT count(DISTINCT episode_index) AS e, count(*) AS n, count(DISTINCT task_index) AS t FROM f)
SELECT e AS total_episodes, n AS total_frames, t AS total_tasks, ceil(e / 1000)::BIGINT AS total_chunks, '0:' || e AS train FROM t""")
def d17(spark, d):
    info = stats.rebuild_info(of_lineitem(spark, d))[0]
    row = (info.total_episodes, info.total_frames, info.total_tasks, info.total_chunks, info.splits["train"])
    return spark.createDataFrame([row], "total_episodes long, total_frames long, total_tasks long, total_chunks long, train string")


@query("j6_mirror_and_merge", f"""WITH {EMBEDDINGS_SQL}, u AS (SELECT 0 AS k, episode_index, frame_index, state[1] AS x FROM f UNION ALL SELECT 1,
  episode_index, frame_index, -state[8] FROM f)
SELECT dense_rank() OVER (ORDER BY k, episode_index) - 1 AS episode_index, row_number() OVER (ORDER BY k, episode_index, frame_index) - 1 AS index,
  round(x, 6) + 0.0 AS x FROM u""")
def j6(spark, d):
    return jobs.mirror_and_merge(
        Dataset.of_frames(frames_from_embeddings(spark, d)), MIRROR
    ).frames.select("episode_index", "index", r6(col_(STATE)[0]).alias("x"))


@query("j7_decimate_and_merge", f"""WITH {EMBEDDINGS_SQL}, u AS (SELECT 0 AS k, episode_index, frame_index, timestamp::DOUBLE AS t FROM f UNION ALL
  SELECT 1, episode_index, frame_index // 3, ((frame_index // 3)::FLOAT * (1 / 30.0)::FLOAT)::DOUBLE FROM f WHERE frame_index % 3 = 0)
SELECT dense_rank() OVER (ORDER BY k, episode_index) - 1 AS episode_index, row_number() OVER (ORDER BY k, episode_index, frame_index) - 1 AS index,
  frame_index, round(t, 4) AS timestamp FROM u""")
def j7(spark, d):
    out = jobs.decimate_and_merge(Dataset.of_frames(frames_from_embeddings(spark, d)), 3).frames
    return out.select("episode_index", "index", "frame_index", F.round(F.col("timestamp").cast("double"), 4).alias("timestamp"))


@query("j9_check_up", f"""WITH {LINEITEM_SQL}, l AS (SELECT episode_index AS e, count(*) AS n FROM f GROUP BY ALL), s AS (SELECT DISTINCT e FROM l),
g AS (SELECT e FROM s WHERE e <> 0 AND e - 1 NOT IN (SELECT e FROM s))
SELECT 'lengths' AS "check", e::VARCHAR AS subject, 'short' AS problem FROM l WHERE n < 2 UNION ALL SELECT 'tasks', task_index::VARCHAR, 'missing'
  FROM (SELECT DISTINCT task_index FROM f WHERE task_index > 5) UNION ALL SELECT 'tasks', '99', 'extra'
UNION ALL SELECT 'metadata', 'episodes ' || e, 'gap' FROM g UNION ALL SELECT 'metadata', 'episodes ' || e, 'task'
  FROM (SELECT DISTINCT episode_index AS e FROM f WHERE task_index > 5) UNION ALL SELECT 'metadata', 'tasks ' || t, 'gap' FROM (SELECT unnest([1,
  99]) AS t)""")
def j9(spark, d):
    return jobs.check_up(odd_tasks(spark, d))


def keyframes(spark, d) -> DataFrame:
    return events(spark, d).select(
        F.concat(F.lit("video "), F.col("episode_index")).alias("path"), F.col("timestamp").cast("double").alias("ts"),
        F.lit(900).cast("long").alias("n_frames")
    )


@query("d20_keyframe_gaps", f"""WITH {EVENTS_SQL}, k AS (SELECT episode_index, timestamp::DOUBLE AS ts FROM f), g AS (SELECT episode_index,
  ts - lag(ts) OVER (PARTITION BY episode_index ORDER BY ts) AS gap FROM k)
SELECT 'video ' || episode_index AS path, count(*) AS keyframes, round(max(gap), 3) AS max_gap, round(avg(gap), 3) AS mean_gap, max(gap) IS NULL
  OR max(gap) > 200000 AS warn FROM g GROUP BY episode_index""")
def d20(spark, d):
    return rounded(
        video.keyframe_gaps(keyframes(spark, d), 30, 200000).select("path", "keyframes", "max_gap", "mean_gap", "warn"), "max_gap", "mean_gap",
        digits=3
    )


@query("d19_format_consistency", """WITH p AS (SELECT event_type AS video_key, event_id AS path, (user_id % 4) AS width,
  CASE WHEN event_type = 'view' THEN 'h264' ELSE 'codec ' || (user_id % 2) END AS codec FROM events)
SELECT video_key, 'width' AS field, arg_min(width::VARCHAR, path) AS first, count(DISTINCT width) AS "values",
  count(DISTINCT width) = 1 AS consistent, round(avg(width), 6) AS mean FROM p GROUP BY video_key
UNION ALL SELECT video_key, 'codec', arg_min(codec, path), count(DISTINCT codec), count(DISTINCT codec) = 1, NULL FROM p GROUP BY video_key""")
def d19(spark, d):
    p = table(spark, d, "events").select(
        F.col("event_type").alias("video_key"), F.col("event_id").alias("path"), (F.col("user_id") % 4).alias("width"),
        F.when(F.col("event_type") == "view", "h264").otherwise(F.concat(F.lit("codec "), F.col("user_id") % 2)).alias("codec")
    )
    return rounded(
        video.format_consistency(p, ["width", "codec"], ["codec"]).select("video_key", "field", "first", "values", "consistent", "mean"), "mean"
    )


@query("e9_frame_glitches")
def e9(spark, d):
    """Embeddings as 8 x 8 pictures."""
    e = table(spark, d, "embeddings")
    floats = F.pandas_udf(lambda s: s.map(lambda x: np.asarray(x, "f4").tobytes()), "binary")
    g = e.select(
        F.floor(F.col("vec_id") / 25).cast("long").alias("episode_index"), F.lit("top").alias("camera"), (F.col("vec_id") % 25).alias("frame_index"),
        F.lit(8).alias("height"), F.lit(8).alias("width"), floats("embedding").alias("gray"), F.lit(None).cast("string").alias("error")
    )
    return rounded(video.glitch_verdicts(video.score_frame_glitches(g)), "max_score")


def queries() -> dict[str, Query]:
    from . import catalog_jobs  # noqa: F401 (registers its own)

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import catalog_jobs  # noqa: F401

    return dict(SQL)
