"""Exact duplicates by composable polynomial fingerprints.

A text is a polynomial over its bytes, ``f(x) = sum((b_i + 1) * x**i)``, evaluated at one point modulo each of two
primes. Chunks are evaluated on their own and combined by length-shifted arithmetic,
``f(ab) = f(a) + x**len(a) * f(b)``, so that a huge document, or one that is stored in pieces, needs no more than
one chunk at a time. Texts of one fingerprint and length are then compared chunk by chunk: each chunk position of a
group is reduced to its smallest and largest chunk by a partially aggregated minimum and maximum, so no group is ever
gathered, and a hot group costs one row a task. Groups in which a chunk differs are split by SHA-256.

Defined results: a null text is an empty text; equal means identical after lower-casing A-Z only; the largest doc_id of
a group stays (nulls count as smallest), and of repeated doc_ids one row stays. Other columns are carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, bounded_batches, broadcast_rows, join_groups, materialize, partitions_for, positional, utf8

PRIMES = (2147483647, 2147483629)
POINTS = (1381258397, 1027350437)
CHUNK = 1 << 16
#: Texts of more bytes are hashed as pieces of PIECE bytes, each where it lies, and the pieces' values combined.
HUGE, PIECE = 4 << 20, 1 << 20
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of the table of fingerprints that occur twice; fixed, so what is broadcast never grows with the data.
BITMAP_BITS = 1 << 23


def powers(point: int, prime: int, n: int) -> np.ndarray:
    """1, x, x**2, ... modulo the prime, by doubling."""
    out = np.ones(1, np.int64)
    while len(out) < n:
        out = np.concatenate([out, out * pow(point, len(out), prime) % prime])
    return out[:n]


_POWERS = None


def chunk_values(chunk: np.ndarray) -> tuple[int, int]:
    """The two values of one chunk of at most CHUNK bytes; the sums stay below 2**56."""
    global _POWERS
    if _POWERS is None:
        _POWERS = [powers(x, p, CHUNK) for x, p in zip(POINTS, PRIMES, strict=True)]
    b = chunk.astype(np.int64) + 1
    return tuple(int(np.dot(b, w[: len(b)])) % p for w, p in zip(_POWERS, PRIMES, strict=True))


def combine(a: tuple[int, int, int], b: tuple[int, int, int]) -> tuple[int, int, int]:
    """Fingerprint (value, value, length) of the joined text from those of its two parts."""
    return tuple((x + pow(r, a[2], p) * y) % p for x, y, r, p in zip(a[:2], b[:2], POINTS, PRIMES, strict=True)) + (a[2] + b[2],)


def fingerprint(data: np.ndarray) -> tuple[int, int, int]:
    done = (0, 0, 0)
    for i in range(0, len(data), CHUNK):
        part = data[i : i + CHUNK]
        done = combine(done, (*chunk_values(part), len(part)))
    return done


def _fingerprints(text_index: int):
    """Rows with the fingerprint, length and SHA-256 of their text; those of huge texts are left null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = utf8(batch.column(text_index))
            keys, sizes, digests = [], [], []
            for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if j - i > HUGE:
                    keys.append(None)
                    sizes.append(j - i)
                    digests.append(None)
                    continue
                lower = data[i:j].tobytes().translate(LOWER)
                a, b, n = fingerprint(np.frombuffer(lower, np.uint8))
                keys.append(a << 31 | b)
                sizes.append(n)
                digests.append(hashlib.sha256(lower).digest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())],
                [*batch.schema.names, "fp", "n", "sha"],
            )

    return run


def fingerprinted(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the columns fp, n, sha and a row number (row), written to the shared folder.

    Huge texts come out of the first pass without a fingerprint; their pieces are dealt to tasks of their own.
    """
    bounded_batches(docs.sparkSession)
    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    schema = T.StructType([*numbered.schema.fields, *T._parse_datatype_string("fp long, n long, sha binary").fields])
    base = materialize(numbered.mapInArrow(_fingerprints(docs.columns.index(text)), schema), "fingerprints")
    huge = base.filter("fp is null")
    if not huge.select("row").limit(1).collect():
        return base
    raw, first = F.col(text).cast("binary"), (F.col("piece") * PIECE + 1).cast("int")
    numbers = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / PIECE))
    places = huge.select("row", text, F.explode(numbers).alias("piece"))
    pieces = places.select("row", "piece", F.substring(raw, first, F.lit(PIECE)).alias("bytes"))
    found = pieces_fingerprint(pieces.repartition(partitions_for(docs.sparkSession), "row", "piece"), "row", "piece", "bytes")
    lowered = F.translate(text, UPPER, SMALL)
    whole = huge.drop("fp", "n", "sha").withColumn("sha", F.unhex(F.sha2(lowered.cast("binary"), 256)))
    return base.filter("fp is not null").unionByName(
        materialize(whole.join(found.withColumnRenamed("doc_id", "row"), "row").select(base.columns), "huge")
    )


def pieces_fingerprint(pieces: DataFrame, doc_id: str, piece_no: str, text: str) -> DataFrame:
    """Fingerprints of documents that are stored in pieces: every piece is hashed where it lies, values are combined.

    Only (number, value, value, length) of the pieces of one document meet, never its text. Returns doc_id, fp, n.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lower = (np.frombuffer((x or b"").translate(LOWER), np.uint8) for x in batch.column(2).to_pylist())
            values = zip(*(fingerprint(x) for x in lower), strict=True) if batch.num_rows else ((), (), ())
            columns = [batch.column(0), batch.column(1), *(pa.array(v, pa.int64()) for v in values)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "a", "b", "n"])

    @F.pandas_udf("fp long, n long")
    def joined(parts):
        import pandas as pd

        out = []
        for row in parts:
            done = (0, 0, 0)
            for p in row:
                done = combine(done, (p["a"], p["b"], p["n"]))
            out.append((done[0] << 31 | done[1], done[2]))
        return pd.DataFrame(out, columns=["fp", "n"])

    bounded_batches(pieces.sparkSession)
    parts = pieces.select(F.col(doc_id).alias("doc_id"), F.col(piece_no).cast("long").alias("piece"), F.col(text).cast("binary").alias("bytes"))
    values = T._parse_datatype_string("piece long, a long, b long, n long").fields
    parts = parts.mapInArrow(hashed, T.StructType([parts.schema["doc_id"], *values]))
    lists = parts.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("piece", "a", "b", "n"))).alias("parts"))
    return lists.select("doc_id", joined("parts").alias("x")).select("doc_id", "x.fp", "x.n")


def _chunks(words: dict[int, int], bits: int):
    table = np.zeros(bits // 64, np.uint64)
    for k, v in words.items():
        table[k] = v & 0xFFFFFFFFFFFFFFFF

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy()
            at = (fp % bits).astype(np.uint64)
            keep = np.flatnonzero(table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1))
            data, offsets = utf8(batch.column(2))
            n, out, held = batch.column(1).to_numpy(), [], 0
            for i in keep.tolist():
                low = data[offsets[i] : offsets[i + 1]].tobytes().translate(LOWER)
                for c in range(0, len(low), CHUNK):
                    out.append((fp[i], n[i], c // CHUNK, low[c : c + CHUNK]))
                held += len(low)
                if held > 8 << 20:
                    yield _chunk_batch(out)
                    out, held = [], 0
            if out:
                yield _chunk_batch(out)

    return run


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["fp", "n", "chunk", "data"])


def colliding(base: DataFrame, text: str, groups: DataFrame, bits: int = BITMAP_BITS) -> bool:
    """Whether two different texts share a fingerprint: chunkwise comparison within all groups of two and more."""
    twice = groups.filter("copies > 1 and n > 0").select((F.col("fp") % bits).alias("bit"))
    words = twice.groupBy(F.floor(F.col("bit") / 64).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits"))
    table = dict(broadcast_rows(words, bits // 64, "bitmap of repeated fingerprints"))
    chunks = base.select("fp", "n", text).mapInArrow(_chunks(table, bits), "fp long, n long, chunk long, data binary")
    differ = chunks.groupBy("fp", "n", "chunk").agg(F.min("data").alias("least"), F.max("data").alias("most")).filter("least != most")
    return bool(differ.limit(1).collect())


def classes(base: DataFrame, doc_id: str, text: str) -> DataFrame:
    """For each row of a fingerprinted table: row, keep_id, group_size, kept (with fp, n, sha and doc_id)."""
    winner = F.max(F.struct(doc_id, "row")).alias("top")
    groups = base.groupBy("fp", "n").agg(F.count(F.lit(1)).alias("copies"), winner)
    keys = ["fp", "n"]
    if colliding(base, text, groups):
        keys.append("sha")
        groups = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"), winner)
    groups = materialize(groups.select(*keys, "copies", F.col(f"top.{doc_id}").alias("keep_id"), F.col("top.row").alias("keep_row")), "groups")
    return join_groups(base.select(doc_id, "row", "fp", "n", "sha"), groups, keys, "copies").select(
        doc_id, "row", "sha", "keep_id", F.col("copies").alias("group_size"), (F.col("row") == F.col("keep_row")).alias("kept")
    )


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    base, _ = positional(docs.select(doc_id, text))
    found = classes(fingerprinted(base, "_1"), "_0", "_1")
    return found.select(F.col("_0").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns unchanged."""
    renamed, names = positional(docs)
    key, body = f"_{names.index(doc_id)}", f"_{names.index(text)}"
    base = fingerprinted(renamed, body)
    stay = classes(base, key, body).filter("kept").select("row")
    return base.join(stay, "row", "left_semi").select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(names)))
