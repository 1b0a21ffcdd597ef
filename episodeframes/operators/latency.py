"""Topic latency of message logs (topic, log_ts_ns, header_ts_ns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import small
from ..sources.datasets import kept
from .quantiles import exact_quantiles


def topic_latency(messages: DataFrame) -> DataFrame:
    """topic, time_s, latency_ms. Messages without a header time (null or 0) don't count; time starts at the earliest of the
    topics' first messages, in the order of the log."""
    valid = messages.filter("header_ts_ns is not null and header_ts_ns <> 0")
    first = valid.groupBy("topic").agg(F.min(F.struct("log_ts_ns", "header_ts_ns")).alias("m")).agg(F.min("m.header_ts_ns").alias("start"))
    timed = valid.crossJoin(F.broadcast(first))  # one row
    return timed.select(
        "topic", ((F.col("header_ts_ns") - F.col("start")) / 1e9).alias("time_s"),
        ((F.col("log_ts_ns") - F.col("header_ts_ns")) / 1e6).alias("latency_ms")
    )


def topic_latency_summary(messages: DataFrame, camera: str = "image|camera") -> DataFrame:
    """Per topic n, median, mean, population std, min, max, and its group (camera or other)."""
    x = "latency_ms"
    timed = kept(topic_latency(messages), "latencies")
    rows = timed.groupBy("topic").agg(
        F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")
    )
    middle = exact_quantiles(timed, ["topic"], x, [0.5], few=None).select("topic", F.col("q")[0].alias("median"))
    rows = rows.join(small(middle), "topic", "left").select("topic", "n", "median", "mean", "std", "min", "max")
    return rows.withColumn("kind", F.when(F.col("topic").rlike(camera), "camera").otherwise("other"))
