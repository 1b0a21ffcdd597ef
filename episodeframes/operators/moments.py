"""Pooled moments: states (n, mean, m2) of parts are merged pairwise, without sums of squares that cancel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Groups that the parts of a whole are merged in before these are: a list holds a 65536th of the parts, then so many states.
GROUPS = 1 << 16
STATE_TYPE = "struct<n:double,mean:double,m2:double>"


def state(n: Column, mean: Column, std: Column) -> Column:
    """What a part adds; null if it has no mean."""
    x = F.struct(n.cast("double").alias("n"), mean.cast("double").alias("mean"), (n * std * std).cast("double").alias("m2"))
    return F.when(mean.isNotNull() & (n > 0), x)


def merged(states: Column) -> Column:
    """One state of an array of states: each step moves the mean by its share of the difference."""

    def step(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"), (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))

    zero = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))
    return F.aggregate(states, zero, step)


def pooled(rows: DataFrame, by: Sequence[str], part: Column, moments: Column, first: Sequence[Column], second: Sequence[Column]) -> DataFrame:
    """(by..., n, mean, std, what ``second`` names). ``moments`` is the state of a row; rows are dealt by ``part``.

    ``first`` are further aggregates of the rows of a group, ``second`` those of the groups.
    """
    dealt = rows.withColumn("_state", moments).withColumn("_group", F.pmod(F.xxhash64(part), F.lit(GROUPS)))
    groups = dealt.groupBy(*by, "_group").agg(F.collect_list("_state").alias("_states"), *first).withColumn("_state", merged(F.col("_states")))
    groups = groups.withColumn("_state", F.when(F.col("_state.n") > 0, F.col("_state"))).drop("_states")
    whole = groups.groupBy(*by).agg(F.collect_list("_state").alias("_states"), *second).withColumn("_state", merged(F.col("_states")))
    n = F.col("_state.n")
    return whole.withColumn("mean", F.when(n > 0, F.col("_state.mean"))).withColumn("std", F.when(n > 0, F.sqrt(F.col("_state.m2") / n))).drop("_states", "_state")
