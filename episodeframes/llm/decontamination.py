"""Benchmark decontamination by spaced seeds: masked hashes find overlaps that tolerate substituted words.

Words are runs of letters and digits, lower-cased. Each MASK picks five of up to eight neighbouring words and ignores the
others; its hash is taken at every word of the benchmark and of the corpus. The masks are chosen so that every window of
8 to 13 words with up to a fifth of them substituted has a hit (held by a test). Corpus windows pass a bit table of fixed
size that the benchmark's hashes have set; runs of neighbouring hits leave with their surroundings as one row, their
hashes are joined with the benchmark's, and each pairing of a run with an item at one offset is verified: some
WINDOW words (all words of a shorter item) must agree in at least four fifths. Items of fewer than LEAST words tolerate
no substitution: they are looked for as whole word sequences, by one hash for each length that the benchmark has.
Nothing is sampled or capped, and the benchmark is broadcast only below MOST_HASHES seeds and MOST_SHORT short items, so it may be as large as
the corpus; the table then lets more through.

Defined results: null and empty texts have no words and are clean, items without words match nothing; items are told apart by their words alone, so ids may be null or used twice: items with the same words
count once and are named by their smallest id, which is null if none has one; repeated documents share their fate;
an empty benchmark leaves all documents clean. Other columns are carried by ``drop_contaminated``.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, broadcast_rows, keyed, materialize, mix64, positional, row_blocks, run_hashes, utf8

MASKS = ((0, 1, 2, 4, 5), (0, 1, 3, 6, 7), (0, 1, 2, 3, 4))
SPAN = 8
LEAST = 8
WINDOW = 13
#: Seeds and short items of the benchmark up to which they are broadcast (some 50 bytes each).
MOST_HASHES, MOST_SHORT = 200_000, 100_000
BITMAP_BITS = 1 << 24
#: Words to both sides of hits that verification may need, and positions of hits in one row at most.
MARGIN, RUN = 16, 512

_WORD_CHARS = None


def word_chars() -> np.ndarray:
    global _WORD_CHARS
    if _WORD_CHARS is None:
        _WORD_CHARS = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    return _WORD_CHARS


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of all texts, and the n + 1 bounds of the texts in them."""
    lower = [(t or "").lower() for t in texts]
    codes = np.frombuffer((" ".join(lower) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(np.fromiter(map(len, lower), np.int64, len(lower)) + 1)
    inside = word_chars()[codes]
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # the last char is a blank
    return run_hashes(codes, first, last), np.concatenate([[0], np.searchsorted(first, ends)])


def seeds(hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(span, hashes of the windows that begin at each word) of every mask."""
    for k, mask in enumerate(MASKS):
        span = mask[-1] + 1
        m = max(0, len(hashes) - span + 1)
        h = np.full(m, k + 1, np.uint64)
        for o in mask:
            h = h * np.uint64(0xD6E8FEB86659FD93) + hashes[o : o + m]
        yield span, mix64(h)


def sequences(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the sequences of n words that begin at each word."""
    h = np.full(max(0, len(hashes) - n + 1), 1000 + n, np.uint64)
    for k in range(n):
        h = h * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + len(h)]
    return mix64(h)


def bits_of(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (h & np.uint64(bits - 1)).astype(np.int64), ((h >> np.uint64(36)) & np.uint64(bits - 1)).astype(np.int64)


def _bench_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The seeds of the items in stretches of RUN positions, each with the words that surround it."""
    for batch in batches:
        out = []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words, _ = word_hashes([text])
            key = hashlib.sha256(words.tobytes()).digest()
            if 0 < len(words) < LEAST:
                whole = int(sequences(words, len(words)).view(np.int64)[0])
                out.append({"item": key, "item_id": item, "n": len(words), "base": 0, "words": [], "hits": [{"hash": whole, "at": 0}]})
                continue
            found = list(seeds(words))
            for at in range(0, len(words), RUN):
                base = max(0, at - MARGIN)
                hits = [{"hash": int(x), "at": p} for _, h in found for p, x in enumerate(h[at : at + RUN].view(np.int64).tolist(), at)]
                out.append(
                    {
                        "item": key, "item_id": item, "n": len(words), "base": base, "words": words[base : at + RUN + MARGIN].view(np.int64).tolist(),
                        "hits": hits
                    }
                )
        if out:
            yield pa.RecordBatch.from_pylist(out, BENCH_SCHEMA)


HITS = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64())]))
BENCH_SCHEMA = pa.schema(
    [("item", pa.binary()), ("item_id", pa.int64()), ("n", pa.int64()), ("base", pa.int64()), ("words", pa.list_(pa.int64())), ("hits", HITS)]
)
BENCH = "item binary, item_id long, n long, base long, words array<long>, hits array<struct<hash:long,at:long>>"
RUNS = "k1 long, k2 long, run long, base long, words array<long>, hits array<struct<hash:long,at:long>>"
RUN_SCHEMA = pa.schema(
    [("k1", pa.int64()), ("k2", pa.int64()), ("run", pa.int64()), ("base", pa.int64()), ("words", pa.list_(pa.int64())), ("hits", HITS)]
)


def _passing(h: np.ndarray, table: np.ndarray, bits: int) -> np.ndarray:
    a, b = bits_of(h, bits)
    return np.flatnonzero(table[a >> 6] >> (a & 63).astype(np.uint64) & table[b >> 6] >> (b & 63).astype(np.uint64) & np.uint64(1))


def _short_hits(words: np.ndarray, bounds: np.ndarray, lengths: list[int], table: np.ndarray, bits: int) -> dict[int, list[int]]:
    """For each text the distinct hashes of sequences that may be a short item."""
    out: dict[int, list[int]] = {}
    for n in lengths:
        h = sequences(words, n)
        at = _passing(h, table, bits)
        doc = np.searchsorted(bounds, at, "right") - 1
        inside = at + n <= bounds[doc + 1]
        for d, x in np.unique(np.stack([doc[inside], h[at[inside]].view(np.int64)], 1), axis=0).tolist():
            out.setdefault(d, []).append(x)
    return out


def _hit_runs(table, bits: int, lengths: list[int]):
    """Runs of hits; number -1 stands for the short items that a text may hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in row_blocks(utf8(batch.column(2))[1]):
                part = batch.slice(i, j - i)
                words, bounds = word_hashes(part.column(2).to_pylist())
                at, hit, out = [], [], []
                for d, found in _short_hits(words, bounds, lengths, table.value, bits).items():
                    key = {"k1": part.column(0)[d].as_py(), "k2": part.column(1)[d].as_py()}
                    out.append({**key, "run": -1, "base": 0, "words": [], "hits": [{"hash": x, "at": 0} for x in found]})
                for span, h in seeds(words):
                    keep = _passing(h, table.value, bits)
                    doc = np.searchsorted(bounds, keep, "right") - 1
                    keep = keep[keep + span <= bounds[doc + 1]]
                    at.append(keep)
                    hit.append(h[keep])
                at, hit = np.concatenate(at), np.concatenate(hit)
                if not len(at) and not out:
                    continue
                order = np.argsort(at, kind="stable")
                at, hit = at[order], hit[order]
                doc = np.searchsorted(bounds, at, "right") - 1
                # a run ends with its document, before a gap, and after RUN positions
                new = np.flatnonzero((np.diff(doc, prepend=-1) > 0) | (np.diff(at, prepend=-(10**9)) > SPAN) | (np.diff(at // RUN, prepend=-1) > 0))
                for x, y in itertools.pairwise([*new.tolist(), len(at)]):
                    d = int(doc[x])
                    base = max(int(bounds[d]), int(at[x]) - MARGIN)
                    end = min(int(bounds[d + 1]), int(at[y - 1]) + MARGIN)
                    out.append({
                        "k1": part.column(0)[d].as_py(), "k2": part.column(1)[d].as_py(), "run": int(at[x] - bounds[d]), "base": int(base - bounds[d]), "words": words[base:end].view(np.int64).tolist(),
                        "hits": [{"hash": h, "at": p} for h, p in zip(hit[x:y].view(np.int64).tolist(), (at[x:y] - bounds[d]).tolist(), strict=True)],
                    })
                yield pa.RecordBatch.from_pylist(out, RUN_SCHEMA)

    return run


def overlap(words: list[int], base: int, item: list[int], item_base: int, n: int, offset: int) -> int:
    """Agreeing words of the best window at this offset (document word = item word + offset); 0 if none is enough."""
    low = max(base, item_base + offset)
    high = min(base + len(words), item_base + offset + len(item))
    size = min(WINDOW, n)
    if high - low < size:
        return 0
    same = np.asarray(words[low - base : high - base]) == np.asarray(item[low - offset - item_base : high - offset - item_base])
    sums = np.concatenate([[0], np.cumsum(same)])
    best = int((sums[size:] - sums[:-size]).max())
    return best if best >= size - size // 5 else 0


@F.pandas_udf(T.IntegerType())
def _overlaps(words, base, item, item_base, n, offset):
    import pandas as pd

    return pd.Series([overlap(*x) for x in zip(words, base, item, item_base, n, offset, strict=True)], dtype="int32")


def contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str, text: str, bits: int = BITMAP_BITS) -> DataFrame:
    """(k1, k2, item_id, n_items, overlap) of the contaminated ones among ``docs`` that have their keys; only item_id may be null."""
    spark = docs.sparkSession
    bounded_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    bench = materialize(items.mapInArrow(_bench_rows, BENCH), "benchmark-seeds")
    # equal items have equal stretches at equal bases, so each stretch finds the same smallest id
    bench = bench.groupBy("item", "base").agg(F.min("item_id").alias("item_id"), *(F.first(c).alias(c) for c in ("n", "words", "hits")))
    every = bench.select("item", "n", "base", F.explode("hits").alias("h")).select("item", "n", "base", "h")
    hashes = every.filter(F.col("n") >= LEAST).select(
        "item", F.col("base").alias("item_base"), F.col("h.hash").alias("hash"), F.col("h.at").alias("item_at")
    )
    short = bench.filter(F.col("n") < LEAST).select("item", "item_id", "n", F.col("hits")[0]["hash"].alias("hash"))
    lengths = sorted(r.n for r in broadcast_rows(short.select("n").distinct(), LEAST, "lengths of short items"))
    bit = F.explode(F.array(F.col("hash").bitwiseAND(bits - 1), F.shiftrightunsigned("hash", 36).bitwiseAND(bits - 1)))
    words = every.select(F.col("h.hash").alias("hash")).select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits")
    )
    table = np.zeros(bits // 64, np.uint64)
    for word, value in broadcast_rows(words, bits // 64, "bit table of the benchmark"):
        table[word] = value & 0xFFFFFFFFFFFFFFFF
    runs = materialize(docs.select("k1", "k2", text).mapInArrow(_hit_runs(spark.sparkContext.broadcast(table), bits, lengths), RUNS), "seed-hits")
    hits = runs.filter("run >= 0").select("k1", "k2", "run", F.explode("hits").alias("h")).select(
        "k1", "k2", "run", F.col("h.hash").alias("hash"), F.col("h.at").alias("at")
    )
    # a phrase of many documents then meets its items where its hits are; beyond that size Spark splits its partition
    hashes = F.broadcast(hashes) if hashes.limit(MOST_HASHES + 1).count() <= MOST_HASHES else hashes
    pairs = hits.join(hashes, "hash").select("k1", "k2", "run", "item", "item_base", (F.col("at") - F.col("item_at")).alias("offset")).distinct()
    segments = bench.select("item", F.col("base").alias("item_base"), "item_id", "n", F.col("words").alias("item_words"))
    sides = pairs.join(
        runs.filter("run >= 0").drop("hits").dropDuplicates(["k1", "k2", "run"]), ["k1", "k2", "run"]
    ).join(segments, ["item", "item_base"])
    held = sides.withColumn("overlap", _overlaps("words", "base", "item_words", "item_base", "n", "offset")).filter("overlap > 0")
    held = held.select("k1", "k2", "item", "item_id", "overlap")
    if lengths:
        few = short.limit(MOST_SHORT + 1).count() <= MOST_SHORT
        whole = runs.filter("run < 0").select("k1", "k2", F.explode("hits.hash").alias("hash")).join(F.broadcast(short) if few else short, "hash")
        held = held.unionByName(whole.select("k1", "k2", "item", "item_id", F.col("n").cast("int").alias("overlap")))
    each = held.groupBy("k1", "k2", "item").agg(F.min("item_id").alias("item_id"), F.max("overlap").alias("overlap"))
    return each.groupBy("k1", "k2").agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("n_items"), F.max("overlap").alias("overlap"))


def find_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, item_id (smallest that overlaps; a label, null without ids), n_items, overlap (words that agree, of WINDOW) of every document."""
    rows = keyed(docs.select("doc_id", "text"), "doc_id", "text")
    found = contaminated(rows, benchmark, "doc_id", "text")
    return rows.select("doc_id", "k1", "k2").join(found, ["k1", "k2"], "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), "item_id", F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("overlap", F.lit(0)).alias("overlap")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The clean documents, with their columns unchanged."""
    renamed, names = positional(docs)
    doc_id, text = f"_{names.index('doc_id')}", f"_{names.index('text')}"
    rows = keyed(renamed, doc_id, text)
    found = contaminated(rows, benchmark, doc_id, text)
    return rows.join(found, ["k1", "k2"], "left_anti").select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(names)))
