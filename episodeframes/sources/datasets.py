"""Reading and writing episode datasets."""

from __future__ import annotations

import json
import tempfile
import uuid
from dataclasses import asdict, fields

import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import EPISODE_STATS_SCHEMA, EPISODES_SCHEMA, TASKS_SCHEMA, Dataset, DatasetInfo, col_
from .episode_files import filesystem, registered, write_episodes, write_lines

#: Parts of names of auxiliary files, which are not data.
BACKUP = r"backup|\.bak"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors see; without that setting only a local master has one."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors see")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """A table written to the shared folder and read back: several uses compute it once, and lost executors don't cost it."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(ds: Dataset) -> Dataset:
    """The dataset with its episodes and tasks written to the shared folder and read back, so that what several checks use,
    and what may be derived from all frames, is computed once."""
    return ds.with_(episodes=kept(ds.episodes, "episodes"), tasks=kept(ds.tasks, "tasks"))


def read_frames(spark: SparkSession, root: str, columns: list[str] | None = None) -> DataFrame:
    """A1: the frames of ``root/data/chunk-*/episode_*.parquet``; only where there are none, of any Parquet file below
    ``root/data`` but backups. A missing episode_index comes from the file name, a missing frame_index is the row's place in
    its file, and numbers stored as lists of one become numbers."""
    try:
        df = spark.read.parquet(f"{root}/data/chunk-*/episode_*[0-9].parquet")
        df = df.filter(F.col("_metadata.file_name").rlike(r"^episode_[0-9]+\.parquet$"))
    except AnalysisException:
        df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(f"{root}/data")
        df = df.filter(~F.lower(F.col("_metadata.file_name")).rlike(BACKUP))
    have = df.columns
    if "episode_index" not in have:
        df = df.withColumn("episode_index", F.regexp_extract(F.col("_metadata.file_path"), r"episode_(\d+)\.parquet$", 1).cast("long"))
    if "frame_index" not in have:
        order = [F.col(c) for c in ("index", "timestamp") if c in have] or [F.monotonically_increasing_id()]
        df = df.withColumn("frame_index", (F.row_number().over(Window.partitionBy("episode_index").orderBy(*order)) - 1).cast("long"))
    for c in ("episode_index", "frame_index", "index", "task_index", "timestamp"):
        if c in df.columns and isinstance(df.schema[c].dataType, T.ArrayType):
            df = df.withColumn(c, F.element_at(c, 1))
    return df.select(*(col_(c) for c in columns)) if columns else df


def read_episode_files(spark: SparkSession, root: str) -> DataFrame:
    """The same files through ``episode_files``: comparisons of episode_index choose files by their names, so a few episodes of
    a large dataset open a few files."""
    return registered(spark).read.format("episode_files").load(root)


def read_info(spark: SparkSession, root: str) -> DatasetInfo:
    """``meta/info.json``, one small object."""
    text = "\n".join(r.value for r in spark.read.text(f"{root}/meta/info.json").collect())
    raw = json.loads(text)
    return DatasetInfo(**{f.name: raw[f.name] for f in fields(DatasetInfo) if f.name in raw})


def _jsonl(spark: SparkSession, path: str, schema: str, optional: bool = False) -> DataFrame:
    """A2: blank lines are skipped, a bad line is an error, a missing optional file is empty."""
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException:
        if not optional:
            raise
        return spark.createDataFrame([], schema)


def read_episodes(spark: SparkSession, root: str, extra: str = "") -> DataFrame:
    return _jsonl(spark, f"{root}/meta/episodes.jsonl", EPISODES_SCHEMA + extra)


def read_tasks(spark: SparkSession, root: str) -> DataFrame:
    return _jsonl(spark, f"{root}/meta/tasks.jsonl", TASKS_SCHEMA)


def read_episode_stats(spark: SparkSession, root: str) -> DataFrame:
    return _jsonl(spark, f"{root}/meta/episodes_stats.jsonl", EPISODE_STATS_SCHEMA, optional=True)


def read_dataset(spark: SparkSession, root: str) -> Dataset:
    return Dataset(
        read_frames(spark, root), read_episodes(spark, root), read_tasks(spark, root), read_info(spark, root), read_episode_stats(spark, root)
    )


def conform_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A4: columns and types of a source schema in its order; other columns follow with their own types."""
    first = [col_(f.name).cast(f.dataType).alias(f.name) for f in schema.fields if f.name in df.columns]
    return df.select(*first, *(col_(c) for c in df.columns if c not in schema.fieldNames()))


def file_inventory(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """A5: path below the root, length, empty or not, and for videos the key (the folder's name); contents are not read."""
    base = root.rstrip("/")
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(base).select("path", "length")
    relative = F.regexp_extract("path", r"^.*?/((?:data|videos|meta)/.*)$", 1)
    return df.select(
        relative.alias("path"), "length", (F.col("length") == 0).alias("empty"),
        F.when(relative.startswith("videos/"), F.regexp_extract(relative, r"([^/]+)/[^/]+$", 1)).alias("video_key")
    )


def write_report(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """A small result as one file."""
    writer = df.coalesce(1).write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.json(path)


def write_dataset(ds: Dataset, root: str, layout: str = "chunked", mode: str = "error") -> None:
    """A3: ``per_episode`` is the layout that others read: a file for each episode at the info's data path, committed as a
    whole. ``chunked`` is Spark's own (``data/episode_chunk=N/part-*``: sorted, few and large files), which only A1 reads.
    Metadata are JSON lines, a file each, sorted by key; ``meta/info.json`` comes last and says that the rest is there."""
    fs, base = filesystem(root)
    if fs.get_file_info(base).type != pafs.FileType.NotFound and mode == "error":
        raise FileExistsError(root)
    if layout == "per_episode":
        write_episodes(ds.frames, root, ds.info.data_path, ds.info.chunks_size)
    else:
        frames = ds.frames.withColumn("episode_chunk", F.floor(F.col("episode_index") / ds.info.chunks_size))
        frames.repartitionByRange("episode_index").sortWithinPartitions(
            "episode_index", "frame_index"
        ).write.mode("overwrite").partitionBy("episode_chunk").parquet(f"{root}/data")
    tables = {"episodes": (ds.episodes, "episode_index"), "tasks": (ds.tasks, "task_index")}
    if ds.stats is not None:
        tables["episodes_stats"] = (ds.stats, "episode_index")
    for name, (df, key) in tables.items():
        write_lines(df, f"{root}/meta/{name}.jsonl", key)
    fs.create_dir(f"{base}/meta", recursive=True)
    with fs.open_output_stream(f"{base}/meta/info.json") as f:
        f.write(json.dumps(asdict(ds.info), indent=2).encode())
