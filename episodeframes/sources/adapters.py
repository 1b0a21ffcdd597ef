"""Frames out of the driver's tables, which hold no robot data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import ACTION, STATE


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; times without a zone are in the session's zone."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def frames_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user is an episode: state = [value, floor(value / 20), k], action = [value], task = the event type's rank."""
    e = table(spark, sf_dir, "events")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    seconds = F.unix_micros("ts") / F.lit(1e6)
    kinds = ["click", "error", "purchase", "scroll", "signup", "view"]
    task = F.coalesce(F.array_position(F.array(*map(F.lit, kinds)), F.col("event_type")), F.lit(0)).cast("long")
    return e.select(
        F.col("user_id").alias("episode_index"),
        (F.row_number().over(w) - 1).cast("long").alias("frame_index"),
        (seconds - F.first(seconds).over(w)).cast("float").alias("timestamp"),
        task.alias("task_index"),
        F.array(F.col("value"), F.floor(F.col("value") / 20).cast("double"), F.get_json_object("props", "$.k").cast("double")).alias(STATE),
        F.array(F.col("value")).alias(ACTION),
    )


#: The same in SQL: a common table expression ``f``.
EVENTS_SQL = """f AS (
  SELECT user_id AS episode_index, row_number() OVER w - 1 AS frame_index,
         (epoch_us(ts) / 1e6 - first_value(epoch_us(ts) / 1e6) OVER w)::FLOAT AS timestamp,
         coalesce(list_position(['click', 'error', 'purchase', 'scroll', 'signup', 'view'], event_type), 0)::BIGINT AS task_index,
         value AS s1, floor(value / 20) AS s2, (props ->> '$.k')::DOUBLE AS s3
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


def messages_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic, log_ts_ns, header_ts_ns; some headers are missing or zero."""
    log = F.unix_micros("ts") * 1000
    header = F.when(F.col("event_id") % 97 == 0, F.lit(0)).when(F.col("event_id") % 97 != 1, log - F.round(F.col("value") * 1000000).cast("long"))
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("topic"), log.alias("log_ts_ns"), header.alias("header_ts_ns"))


MESSAGES_SQL = """m AS (
  SELECT event_type AS topic, epoch_us(ts) * 1000 AS log_ts_ns,
         CASE WHEN event_id % 97 = 0 THEN 0 WHEN event_id % 97 <> 1 THEN epoch_us(ts) * 1000 - round(value * 1000000)::BIGINT END AS header_ts_ns
  FROM events)"""


def frames_from_embeddings(spark: SparkSession, sf_dir: str, per_episode: int = 25) -> DataFrame:
    """Fourteen-dimensional states and actions: slices of an embedding, 25 frames an episode."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.floor(F.col("vec_id") / per_episode).cast("long").alias("episode_index"), (F.col("vec_id") % per_episode).cast("long").alias("frame_index"),
        F.col("vec_id").alias("index"), (
            (F.col("vec_id") % per_episode) / F.lit(30.0)
        ).cast("float").alias("timestamp"), F.col("label").cast("long").alias("task_index"),
        F.slice("embedding", 1, 14).cast("array<double>").alias(STATE), F.slice("embedding", 15, 14).cast("array<double>").alias(ACTION),
    )


EMBEDDINGS_SQL = """f AS (
  SELECT vec_id // 25 AS episode_index, vec_id % 25 AS frame_index, vec_id AS index, ((vec_id % 25) / 30.0)::FLOAT AS timestamp, label::BIGINT AS task_index,
         embedding[1:14]::DOUBLE[] AS state, embedding[15:28]::DOUBLE[] AS action FROM embeddings)"""


def frames_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is an episode. Line numbers repeat, so frames are numbered by an order over several columns."""
    item = table(spark, sf_dir, "lineitem")
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount", "l_tax"
    )
    return item.select(
        F.col("l_orderkey").alias("episode_index"), (F.row_number().over(w) - 1).cast("long").alias("frame_index"),
        F.col("l_linenumber").cast("long").alias("task_index"), F.array(
            "l_quantity", "l_extendedprice"
        ).alias(STATE), F.array("l_discount", "l_tax").alias(ACTION),
    )


LINEITEM_SQL = """f AS (
  SELECT l_orderkey AS episode_index, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount, l_tax) - 1 AS frame_index,
         l_linenumber::BIGINT AS task_index, l_quantity AS s1, l_extendedprice AS s2, l_discount AS a1, l_tax AS a2 FROM lineitem)"""


def episodes_from_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("episode_index"), F.col("turn").alias("frame_index"), F.col("role"))
