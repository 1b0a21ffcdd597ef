"""Data sources in Spark for what the layout prescribes as single files: an episode's Parquet file, and JSON lines.

``episode_files`` reads ``data/**/episode_*.parquet``: partitions are groups of neighbouring episodes of bounded bytes, and
comparisons of ``episode_index`` drop files by the number in their name before any is opened. It writes a file for each
episode: tasks write under names of the attempt in a folder beside the data and list what they wrote in a manifest; only when
all have ended, the commit names the manifests that count, and ``publish`` moves their files into place, in tasks too and so
that a second try finishes what a first began. A task that dies leaves nothing in ``data``; an abort removes the attempts.

``json_lines`` writes rows of one text column to one file, in the same way, and moves it when the job commits.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from ..functions.vectors import FIELD

EPISODE_FILE = re.compile(r"(?:^|/)episode_(\d+)\.parquet$")
#: Bytes of the files that one task reads, one file at least.
PARTITION_BYTES = 128 << 20
ATTEMPTS = "_attempts"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}")


def episode_files(root: str) -> list[tuple[int, str, int]]:
    """(episode, path, bytes) of the episode files below ``root/data``, in order; nothing else there counts."""
    fs, base = filesystem(root)
    found = fs.get_file_info(pafs.FileSelector(f"{base}/data", recursive=True, allow_not_found=True))
    return sorted((int(m[1]), x.path, x.size) for x in found if x.is_file and (m := EPISODE_FILE.search(x.path)))


def episode_path(template: str, chunks_size: int, episode: int) -> str:
    values = {"episode_index": episode, "episode_chunk": episode // chunks_size}
    return FIELD.sub(lambda m: f"{values[m[1]]:0{m[2] or 1}d}", template)


@dataclass
class Files(InputPartition):
    files: list[tuple[int, str]]


class EpisodeReader(DataSourceReader):
    def __init__(self, root: str, schema: StructType):
        self.root, self.names = root, schema.fieldNames()
        self.tests: list[tuple[str, object]] = []

    def pushFilters(self, filters: list) -> Iterator:
        """Comparisons of episode_index choose files; all filters are evaluated by Spark again."""
        kinds = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in"}
        for f in filters:
            if type(f) in kinds and f.attribute == ("episode_index",):
                self.tests.append((kinds[type(f)], f.value))
            yield f

    def wanted(self, episode: int) -> bool:
        rules = {"==": int.__eq__, ">": int.__gt__, ">=": int.__ge__, "<": int.__lt__, "<=": int.__le__, "in": lambda e, v: e in v}
        return all(rules[k](episode, v) for k, v in self.tests)

    def partitions(self) -> list[Files]:
        out, held = [], 0
        for episode, path, size in episode_files(self.root):
            if self.wanted(episode):
                if not out or held + size > PARTITION_BYTES:
                    out.append(Files([]))
                    held = 0
                out[-1].files.append((episode, path))
                held += size
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(self.root)
        for episode, path in partition.files:
            with fs.open_input_file(path) as f:
                for batch in pq.ParquetFile(f).iter_batches(8192):
                    if "episode_index" not in batch.schema.names:  # its file's number
                        batch = batch.append_column("episode_index", pa.array([episode] * batch.num_rows, pa.int64()))
                    yield batch.select(self.names)


@dataclass
class Part(WriterCommitMessage):
    manifest: str | None
    rows: int


class EpisodeWriter(DataSourceArrowWriter):
    """Rows come sorted by episode, each episode in one task."""

    def __init__(self, options: dict, names: list[str]):
        self.root, self.template, self.size = options["path"], options["template"], int(options["chunks_size"])
        self.job, self.names = options["job"], names

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        fs, base = filesystem(self.root)
        folder, rows, files, writer, now = f"{base}/{ATTEMPTS}/{self.job}", 0, [], None, None
        fs.create_dir(folder, recursive=True)
        at = self.names.index("episode_index")
        try:
            for batch in iterator:
                episodes, begin = batch.column(at).to_pylist(), 0
                for end in [i for i in range(1, len(episodes)) if episodes[i] != episodes[i - 1]] + [len(episodes)]:
                    if begin == end:
                        continue
                    if episodes[begin] != now or writer is None:
                        if writer:
                            writer.close()
                        now, attempt = episodes[begin], f"{folder}/{uuid.uuid4().hex}.parquet"
                        writer = pq.ParquetWriter(attempt, batch.schema, filesystem=fs)
                        files.append({"attempt": attempt, "path": f"{base}/{episode_path(self.template, self.size, now)}"})
                    writer.write_batch(batch.slice(begin, end - begin))
                    rows, begin = rows + end - begin, end
        finally:
            if writer:
                writer.close()
        if not files:
            return Part(None, 0)
        manifest = f"{folder}/{uuid.uuid4().hex}.manifest"
        with fs.open_output_stream(manifest) as f:
            f.write("".join(json.dumps(x) + "\n" for x in files).encode())
        return Part(manifest, rows)

    def commit(self, messages: list[Part | None]) -> None:
        fs, base = filesystem(self.root)
        fs.create_dir(f"{base}/{ATTEMPTS}/{self.job}", recursive=True)
        with fs.open_output_stream(f"{base}/{ATTEMPTS}/{self.job}/committed") as f:
            f.write("".join(m.manifest + "\n" for m in messages if m and m.manifest).encode())

    def abort(self, messages: list[Part | None]) -> None:
        fs, base = filesystem(self.root)
        if fs.get_file_info(f"{base}/{ATTEMPTS}/{self.job}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{base}/{ATTEMPTS}/{self.job}")


class LinesWriter(DataSourceArrowWriter):
    """One task's texts, a line each, under a name of the attempt; the commit moves the file."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        fs, path = filesystem(self.path)
        folder, name = path.rsplit("/", 1)
        fs.create_dir(folder, recursive=True)
        attempt, rows = f"{folder}/.{name}.{uuid.uuid4().hex}", 0
        with fs.open_output_stream(attempt) as f:
            for batch in iterator:
                f.write("".join(f"{x}\n" for x in batch.column(0).to_pylist()).encode())
                rows += batch.num_rows
        return Part(attempt, rows)

    def commit(self, messages: list[Part | None]) -> None:
        fs, path = filesystem(self.path)
        found = [m for m in messages if m]
        if sum(m.rows > 0 for m in found) > 1:
            self.abort(messages)
            raise ValueError("lines of one file come from one task")
        for m in sorted(found, key=lambda m: m.rows):  # tasks without rows first
            fs.move(m.manifest, path)

    def abort(self, messages: list[Part | None]) -> None:
        fs, _ = filesystem(self.path)
        for m in messages:
            if m:
                fs.delete_file(m.manifest)


class EpisodeFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "episode_files"

    def schema(self) -> StructType:
        """That of the first episode's file, with episode_index."""
        files = episode_files(self.options["path"])
        if not files:
            raise FileNotFoundError(f"no episode files below {self.options['path']}/data")
        fs, _ = filesystem(self.options["path"])
        with fs.open_input_file(files[0][1]) as f:
            found = pq.ParquetFile(f).schema_arrow
        # lists of fixed size are lists to Spark
        fields = [pa.field(x.name, pa.list_(x.type.value_type) if pa.types.is_fixed_size_list(x.type) else x.type) for x in found]
        if "episode_index" not in found.names:
            fields.append(pa.field("episode_index", pa.int64()))
        return from_arrow_schema(pa.schema(fields))

    def reader(self, schema: StructType) -> EpisodeReader:
        return EpisodeReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> EpisodeWriter:
        return EpisodeWriter(dict(self.options), schema.fieldNames())


class JsonLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "json_lines"

    def schema(self) -> str:
        return "value string"

    def writer(self, schema: StructType, overwrite: bool) -> LinesWriter:
        return LinesWriter(dict(self.options))


def registered(spark: SparkSession) -> SparkSession:
    """The session with both sources; comparisons reach the reader."""
    spark.dataSource.register(EpisodeFiles)
    spark.dataSource.register(JsonLines)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def _publish(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = filesystem(root)
        for batch in batches:
            for row in batch.to_pylist():
                there = fs.get_file_info([row["attempt"], row["path"]])
                if there[0].type != pafs.FileType.NotFound:
                    fs.create_dir(row["path"].rsplit("/", 1)[0], recursive=True)
                    fs.move(row["attempt"], row["path"])
                elif there[1].type == pafs.FileType.NotFound:
                    raise FileNotFoundError(row["attempt"])
            yield batch

    return run


def write_episodes(frames: DataFrame, root: str, template: str, chunks_size: int) -> None:
    """A file for each episode at the path template, frames in order."""
    spark, job = registered(frames.sparkSession), uuid.uuid4().hex
    order = frames.repartitionByRange("episode_index").sortWithinPartitions("episode_index", "frame_index")
    order.write.format("episode_files").mode("append").options(template=template, chunks_size=str(chunks_size), job=job).save(root)
    fs, base = filesystem(root)
    folder = f"{base}/{ATTEMPTS}/{job}"
    with fs.open_input_stream(f"{folder}/committed") as f:
        manifests = f.read().decode().split()
    if manifests:
        scheme = root.split("://")[0] + "://" if "://" in root else "file://"
        listed = spark.read.schema("attempt string, path string").json([scheme + m for m in manifests])
        listed.repartition(max(1, min(len(manifests) * 4, spark.sparkContext.defaultParallelism * 4)), F.col("path")).mapInArrow(
            _publish(root), "attempt string, path string"
        ).write.format("noop").mode("overwrite").save()
    fs.delete_dir(f"{base}/{ATTEMPTS}")


def write_lines(df: DataFrame, path: str, key: str) -> None:
    """JSON lines in one file, sorted by the key: sorted in one task that streams, as one file is written by one."""
    registered(df.sparkSession)
    lines = df.repartition(1).sortWithinPartitions(key).select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns))).alias("value"))
    lines.write.format("json_lines").mode("append").save(path)
