"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows of input partition i go to shard j is drawn beforehand: for a uniform permutation the matrix of counts is
multivariate hypergeometric, row by row, given the partitions' row counts and the shards' exact sizes. Each task then
permutes the labels of its own row of the matrix over its rows and gives every row a random key; the exchange deals rows
to (shard, range of keys), and each such piece is sorted by key: the second permutation. A shard is as many pieces as the
cluster needs, so its size doesn't bound a task. First slots come from sums over the pieces' counts. The driver
holds the matrix (partitions x shards counts) and a row for each piece, never rows of data.

Defined results: every row, repeated or with nulls, gets one (shard, slot); sizes differ by one at most; an empty table
gives no rows; all columns are carried. The input's partitions must be read alike twice; the counts that arrive are held
against the matrix, and the shuffle is done again if they differ.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import broadcast_rows, materialize, partitions_for, positional

#: numpy draws hypergeometric counts of fewer rows than this; beyond, ``draw`` walks out from the mode.
NUMPY_MOST = 10**9
MOST_PARTITIONS = 10**7


def draw(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """A hypergeometric count by inversion from the mode outwards; the walk is a few standard deviations long."""
    if min(good, bad, sample) == 0 or sample == good + bad:
        return 0 if not good or not sample else min(good, sample)
    if good + bad < NUMPY_MOST:
        return int(rng.hypergeometric(good, bad, sample))
    low, high = max(0, sample - bad), min(good, sample)
    mode = min(high, max(low, (sample + 1) * (good + 1) // (good + bad + 2)))
    log = math.lgamma
    p = math.exp(
        log(good + 1) - log(mode + 1) - log(good - mode + 1) + log(bad + 1) - log(sample - mode + 1) - log(bad - sample + mode + 1)
        - log(good + bad + 1) + log(sample + 1) + log(good + bad - sample + 1)
    )
    u, left, right, pl, pr = rng.random() - p, mode, mode, p, p
    while u > 0 and (left > low or right < high):
        if right < high:
            pr *= (good - right) * (sample - right) / ((right + 1) * (bad - sample + right + 1))
            right += 1
            if (u := u - pr) <= 0:
                return right
        if left > low:
            pl *= left * (bad - sample + left) / ((good - left + 1) * (sample - left + 1))
            left -= 1
            if (u := u - pl) <= 0:
                return left
    return mode


def communication_matrix(rng: np.random.Generator, rows: list[int], sizes: list[int]) -> np.ndarray:
    """Counts [partition, shard] with these row and column sums, as of a uniform permutation."""
    left, out = list(sizes), np.zeros((len(rows), len(sizes)), np.int64)
    for i, n in enumerate(rows):
        rest = sum(left)
        for j, size in enumerate(left):
            out[i, j] = k = draw(rng, size, rest - size, n)
            rest, n = rest - size, n - k
            left[j] -= k
    return out


def exact_sizes(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def _deal(matrix, seed: int, pieces: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        rng = np.random.default_rng([seed, part])
        counts = matrix.value[part] if part < len(matrix.value) else np.zeros(matrix.value.shape[1], np.int64)
        labels, at = rng.permutation(np.repeat(np.arange(len(counts), dtype=np.int32), counts)), 0
        for batch in batches:
            n = batch.num_rows
            shard = labels[at : at + n]
            if len(shard) < n:  # more rows than were counted: the caller sees it in the counts and deals again
                shard = np.append(shard, np.zeros(n - len(shard), np.int32))
            key = rng.integers(0, 1 << 62, n)
            piece = ((key >> 31) * pieces >> 31).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns, pa.array(shard), pa.array(shard * pieces + piece), pa.array(key), pa.array(np.full(n, part, np.int32)),
                    pa.array(np.arange(at, at + n))
                ],
                [*batch.schema.names, "shard", "target", "key", "part", "row"],
            )
            at += n

    return run


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0, pieces: int | None = None) -> DataFrame:
    """The rows of ``df`` with shard (int) and slot (long, gapless from 0 within its shard), from the written shards."""
    spark = df.sparkSession
    rows, names = positional(df)
    pieces = pieces or max(1, -(-partitions_for(spark) // shards))
    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string("shard int, target int, key long, part int, row long").fields])
    for attempt in range(3):
        counted = rows.select(F.spark_partition_id().alias("part")).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        counts = dict(map(tuple, broadcast_rows(counted, MOST_PARTITIONS, "partitions")))
        each = [counts.get(i, 0) for i in range(max(counts, default=-1) + 1)]
        matrix = communication_matrix(np.random.default_rng([seed, attempt]), each, exact_sizes(sum(each), shards)).reshape(-1, shards)
        dealt = rows.mapInArrow(_deal(spark.sparkContext.broadcast(matrix), seed, pieces), schema)
        placed = dealt.repartitionById(shards * pieces, "target").sortWithinPartitions("target", "key", "part", "row").withColumn(
            "at", F.monotonically_increasing_id()
        )
        written = materialize(placed, "shards")
        arrived = written.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
        found = {(r.part, r.shard): r.n for r in broadcast_rows(arrived, MOST_PARTITIONS * shards, "partitions x shards")}
        if found == {(i, j): n for (i, j), n in np.ndenumerate(matrix) if n}:
            break
    else:
        raise RuntimeError("the input's partitions differ each time they are read; write it to a table first")
    sizes = written.groupBy("shard", "target").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("target").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = sizes.select("target", (before - F.col("first")).alias("base"))
    out = written.join(F.broadcast(bases), "target")  # a row for each piece
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(names)), "shard", (F.col("base") + F.col("at")).alias("slot"))


def shards_query(spark: SparkSession, docs: DataFrame, shards: int = 8) -> DataFrame:
    placed = shuffle_into_shards(docs.select("doc_id", "text"), shards)
    raw = F.coalesce(F.encode("text", "UTF-8"), F.lit(b""))
    return placed.select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
