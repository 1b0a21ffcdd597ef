"""What the text operators share: scratch tables, Arrow text buffers and byte ranges."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a helper takes up at once inside a task; temporaries are a small multiple of it.
BLOCK_BYTES = 2 << 20


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a folder of our own only where that is not set and the master is local."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or getattr(scratch_path, "own", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        base = scratch_path.own = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Rows go to Python in Arrow batches of bounded bytes, not of 10,000 rows; long texts make those large.

    A setting of the session: it is read when a query runs, which may be after the operator has returned.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(2 * BLOCK_BYTES))


def broadcast_rows(df: DataFrame, most: int, what: str) -> list:
    """Rows of a table whose size is bounded by construction (partitions, languages, words of a bitmap); checked."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what}: more than {most} rows")
    return rows


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """The same rows under the column names ``_0``, ``_1``, ...: no name of the input can clash with ours."""
    return df.toDF(*(f"_{i}" for i in range(len(df.columns)))), list(df.columns)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets into them; a null is an empty text."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def row_blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``most`` bytes each, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


#: Lower-cases A-Z alone, for ``bytes.translate``.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
HASH_KEY = np.uint64(0x5851F42D4C957F2D)

#: A group with more than this share of all rows (and more than LIGHT rows) is joined on its own; there are fewer than 1 / HEAVY.
HEAVY, LIGHT = 1 / 1000, 512


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str) -> DataFrame:
    """``rows`` with the columns of their group. ``groups`` (written, one row for each key) counts its rows in ``size``.

    Heavy groups, of which there can only be 1 / HEAVY, are broadcast, so that none lands in one task; the rest is shuffled.
    """
    total, most = groups.agg(F.coalesce(F.sum(size), F.lit(0)), F.coalesce(F.max(size), F.lit(0))).first()
    limit = max(LIGHT, total * HEAVY)
    if most <= limit:
        return rows.join(groups, keys)
    few, rest = groups.filter(F.col(size) > limit), groups.filter(F.col(size) <= limit)
    others = rows.join(F.broadcast(few.select(*keys)), keys, "left_anti")
    return rows.join(F.broadcast(few), keys).unionByName(others.join(rest, keys))


def partitions_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc32_of(text: str) -> str:
    """SQL for the unsigned crc32 of a text's UTF-8 bytes (null: of no bytes)."""
    return f"crc32(coalesce(encode({text}, 'UTF-8'), X''))"


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _coded(place: np.ndarray, code: np.ndarray) -> np.ndarray:
    return mix64(mix64(place.astype(np.uint64) + HASH_KEY) ^ code.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


_CODED = None


def run_hashes(codes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs ``codes[first:last]``, which don't overlap and are in order.

    Each is a sum of a pseudo-random function of (place in the run, code), so unlike powers of one number it has no
    algebra in which two runs cancel out. Its values for the first 64 places and 256 codes come from a table. Runs are
    taken some 2**18 codes at a time.
    """
    global _CODED
    if _CODED is None:
        _CODED = _coded(np.arange(1 << 14) >> 8, np.arange(1 << 14) & 255)
    out, size = np.zeros(len(first), np.uint64), last - first
    ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
    for i, j in row_blocks(ends, 1 << 18):
        starts, each = ends[i:j] - ends[i], np.arange(ends[j] - ends[i])
        code = codes[each + np.repeat(first[i:j] - starts, size[i:j])].astype(np.int64)
        place = each - np.repeat(starts, size[i:j])
        value = _CODED[(place & 63) << 8 | code & 255]
        rare = np.flatnonzero((place > 63) | (code > 255))
        value[rare] = _coded(place[rare], code[rare])
        out[i:j] = np.add.reduceat(value, starts)
    return mix64(out ^ size.astype(np.uint64))


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """128 bits that stand for a document's id and text; never null."""
    return docs.withColumn("k1", F.xxhash64(doc_id, text)).withColumn("k2", F.xxhash64(F.lit(7), text, doc_id))


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Documents kept from every fit: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))
