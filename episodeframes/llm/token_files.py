"""Flat token files: unsigned integers, 64-bit document offsets, prefix sums for the place of each part.

Documents are dealt to parts by ranges of doc_id and sorted within them. Each task writes the ids of its part, one
after the other, to ``part-*.tokens`` and the ids and lengths of its documents beside it, under names of the attempt;
the manifest row that Spark commits names the files that count, so a lost executor or a second attempt does no harm.
The manifest has a row per part; running sums over it give the first token of every part, and a second pass writes
``part-*.offsets``: n + 1 unsigned 64-bit positions in the whole corpus. Readers map the files into memory (stores that
can't be mapped are read through their Arrow file system).

Defined results: a null text has no tokens but still gets the end id; documents are in ascending doc_id order, nulls
first, repeated ids in any order; an empty table gives no parts. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, bounded_batches, materialize, partitions_for, positional, row_blocks, scratch_path, utf8

#: ``nulls``: so many documents of the part, its first, have no id.
MANIFEST = "part int, path string, docs long, nulls long, tokens long"
#: Texts of these characters alone are split word by word here; the library takes all others whole.
PLAIN = re.compile(r"[^\x00-\xff]|<\|")
LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
SPACES = r"\t\n\x0b\x0c\r \x85\xa0"
WORDS = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{DIGITS}]|[^{SPACES}{LETTERS}{DIGITS}]+")
#: Bytes of words that a worker keeps in each of two generations, and of words sent to the library at once.
MOST_BYTES, WORDS_AT_ONCE = 40 << 20, 1 << 20
#: Characters from which on a text is split into words some WORDS_A_PIECE at a time.
WHOLE, WORDS_A_PIECE = 1 << 20, 100_000


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class WordEncoder:
    """Ids of whole texts from the tokenizer of the library; the ids of a word are asked for once while it recurs.

    New words go to the library many at a time, apart by blanks, through the tokenizer's own model and byte mapping; its
    end-of-word mark tells them apart again. A tokenizer without that mark takes them one by one.
    """

    def __init__(self, tokenizer_path: str, dtype: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer, self.dtype = Tokenizer.from_file(tokenizer_path), np.dtype(dtype)
        self.model = Tokenizer.from_file(tokenizer_path)
        self.model.normalizer = normalizers.Sequence([])
        self.model.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        mark = getattr(self.model.model, "end_of_word_suffix", None)
        self.ends = np.zeros(self.model.get_vocab_size(), bool)
        for token, i in self.model.get_vocab().items():
            self.ends[i] = bool(mark) and token.endswith(mark)
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word_ids(self, words: list[str]) -> list[bytes]:
        ids = np.array(self.model.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, self.dtype)
        cut = np.flatnonzero(self.ends[ids]) + 1
        if len(cut) != len(words) or cut[-1] != len(ids):
            return self.ids(words)
        raw, cut = ids.tobytes(), (cut * self.dtype.itemsize).tolist()
        return [raw[i:j] for i, j in zip([0, *cut[:-1]], cut, strict=True)]

    def known(self, words: set[str]) -> dict[str, bytes]:
        """Ids of at least these words. What was not used for MOST_BYTES of words is forgotten."""
        if self.held > MOST_BYTES:
            self.recent, self.older, self.held = {}, self.recent, 0
        missing = words - self.recent.keys()
        found = {x: self.older[x] for x in missing & self.older.keys()}
        some, size = [], 0
        for x in missing - found.keys():
            some.append(x)
            size += len(x) + 1
            if size > WORDS_AT_ONCE:
                found.update(zip(some, self.word_ids(some), strict=True))
                some, size = [], 0
        if some:
            found.update(zip(some, self.word_ids(some), strict=True))
        self.recent.update(found)
        self.held += sum(len(k) + len(v) for k, v in found.items()) + 200 * len(found)
        return self.recent

    def encode(self, texts: list[str | None]) -> list[bytes]:
        long = [t is not None and len(t) >= WHOLE for t in texts]
        split = [None if t and (big or PLAIN.search(t)) else WORDS.findall(t.lower()) if t else [] for t, big in zip(texts, long, strict=True)]
        get = self.known(set().union(*(words for words in split if words))).__getitem__
        out = [b"" if words is None else b"".join(map(get, words)) for words in split]
        for i, t in enumerate(texts):  # after the others, whose words these may clear
            if split[i] is None:
                out[i] = self.ids([t])[0] if PLAIN.search(t) else self.encode_long(t)
        return out

    def encode_long(self, text: str) -> bytes:
        found, parts = (x.group() for x in WORDS.finditer(text.lower())), []
        while words := list(itertools.islice(found, WORDS_A_PIECE)):
            parts.append(b"".join(map(self.known(set(words)).__getitem__, words)))
        return b"".join(parts)


_ENCODERS: dict[tuple[str, str], WordEncoder] = {}


def encoder(tokenizer_path: str, dtype: str) -> WordEncoder:
    """One for each worker process, kept between tasks."""
    key = (tokenizer_path, dtype)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(tokenizer_path, dtype)
    return _ENCODERS[key]


def _write_part(folder: str, tokenizer_path: str, end_id: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, stem = TaskContext.get().partitionId(), f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        code, end, width = encoder(tokenizer_path, dtype), np.array([end_id], dtype).tobytes(), np.dtype(dtype).itemsize
        fs, path = opened(stem)
        files, docs, nulls, tokens = None, 0, 0, 0
        for batch in batches:
            for i, j in row_blocks(utf8(batch.column(1))[1]):
                rows = batch.slice(i, j - i)
                if files is None:
                    fs.create_dir(os.path.dirname(path), recursive=True)
                    files = [fs.open_output_stream(path + end) for end in (".tokens", ".docs", ".lengths")]
                coded = code.encode(rows.column(1).to_pylist())
                lengths = np.array([len(c) // width + 1 for c in coded], "<u8")
                files[0].write(b"".join(x for c in coded for x in (c, end)))
                files[1].write(pc.fill_null(rows.column(0), 0).to_numpy().astype("<i8").tobytes())
                nulls += rows.column(0).null_count
                files[2].write(lengths.tobytes())
                docs, tokens = docs + len(coded), tokens + int(lengths.sum())
        if files:
            for f in files:
                f.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "path": stem, "docs": docs, "nulls": nulls, "tokens": tokens}],
                pa.schema([("part", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("nulls", pa.int64()), ("tokens", pa.int64())])
            )

    return run


def load(uri: str, dtype: str) -> np.ndarray:
    """A file as an array: mapped into memory where its store allows it."""
    fs, path = opened(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


def _write_offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            lengths = load(row["path"] + ".lengths", "<u8")
            offsets = np.concatenate([[row["base"]], row["base"] + np.cumsum(lengths, dtype=np.int64)]).astype("<u8")
            fs, path = opened(row["path"])
            attempt = f"{path}.{uuid.uuid4().hex}"
            with fs.open_output_stream(attempt) as f:
                f.write(offsets.tobytes())
            fs.move(attempt, f"{path}.offsets")
        yield batch


def write_token_files(
    docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, dtype: str = "<u2", doc_id: str = "doc_id", text: str = "text",
    parts: int | None = None
) -> DataFrame:
    """Write the corpus to ``folder`` (default: the shared folder); returns the manifest: part, path, docs, nulls, tokens, base."""
    spark = docs.sparkSession
    bounded_batches(spark)
    folder = folder or scratch_path(spark, "tokens")
    rows, _ = positional(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))
    parts = parts or max(partitions_for(spark), rows.rdd.getNumPartitions())
    ordered = rows.withColumn(
        "tie", F.monotonically_increasing_id()
    ).repartitionByRange(parts, "_0", "tie").sortWithinPartitions("_0", "tie").drop("tie")
    manifest = materialize(ordered.mapInArrow(_write_part(folder, tokenizer_path, end_id, dtype), MANIFEST), "manifest")
    base = F.sum("tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.withColumn("base", F.coalesce(base, F.lit(0).cast("long")))
    return materialize(placed.repartition(parts, "part").mapInArrow(_write_offsets, placed.schema), "placed")


def _read_part(dtype: str, columns):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens, offsets, ids = load(row["path"] + ".tokens", dtype), load(
                    row["path"] + ".offsets", "<u8"
                ).astype(np.int64), load(row["path"] + ".docs", "<i8")
                none = np.arange(len(ids)) < row["nulls"]
                for i, j in row_blocks(offsets, BLOCK_BYTES // 8):  # blocks of bounded bytes, one document at least
                    yield columns(pa.array(ids[i:j], pa.int64(), mask=none[i:j]), offsets[i : j + 1], tokens, row["base"])

    return run


def read_tokens(manifest: DataFrame, dtype: str = "<u2") -> DataFrame:
    """The documents back from the files: doc_id, start, tokens (array of long, with the end id)."""

    def columns(ids, offsets, tokens, base):
        values = pa.ListArray.from_arrays(
            pa.array(offsets - offsets[0], pa.int32()), pa.array(tokens[offsets[0] - base : offsets[-1] - base].astype(np.int64))
        )  # a text of less than 2 GB has fewer than 2**31 tokens
        return pa.RecordBatch.from_arrays([ids, pa.array(offsets[:-1], pa.int64()), values], ["doc_id", "start", "tokens"])

    return spread(manifest).mapInArrow(_read_part(dtype, columns), "doc_id long, start long, tokens array<long>")


def read_digests(manifest: DataFrame, dtype: str = "<u2") -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as unsigned 32-bit integers, from the files."""

    def columns(ids, offsets, tokens, base):
        wide = tokens[offsets[0] - base : offsets[-1] - base].astype("<u4")
        at = (offsets - offsets[0]).tolist()
        crc = [zlib.crc32(wide[i:j]) for i, j in zip(at[:-1], at[1:], strict=True)]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(offsets[:-1], pa.int64()), pa.array(np.diff(offsets), pa.int64()), pa.array(crc, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"]
        )

    return spread(manifest).mapInArrow(_read_part(dtype, columns), "doc_id long, start long, n_tokens long, ids_crc32 long")


def spread(manifest: DataFrame) -> DataFrame:
    """A task for every few parts; the manifest itself is small."""
    return manifest.repartition(partitions_for(manifest.sparkSession), "part")


def token_files_query(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    return read_digests(write_token_files(docs, tokenizer_path, end_id))
