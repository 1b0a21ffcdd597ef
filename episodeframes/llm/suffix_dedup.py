"""Repeated byte windows by a depth-limited radix sort of suffixes, most significant digit first.

Wanted is which windows of WIDTH bytes also start in a document with a smaller id. Suffixes are only ever ordered through
WIDTH bytes, in passes; after each, suffixes that share their digits with no other document drop out, and equal groups after
the last pass are exactly the repeated windows.

Pass 1 sorts one suffix for each stretch of neighbouring windows: every window names an anchor, a place in it that its bytes
alone decide (a modular minimizer), so equal windows name equal anchors; digit 1 is the GRAM bytes at the anchor, digit 2
the whole stretch of bytes that its windows cover. Equal stretches make all windows of all but the smallest document
repeated. Stretches that share digit 1 with another document but not digit 2 go to pass 2, which sorts each of their
windows by all WIDTH bytes. Digits are keys of byte strings: of 64 bits for a stretch among those of one gram, of 96 bits
(two sums with independent random tables) for a window. A task combines equal suffixes before the
exchange (only the smallest document's is sent), and a digit that it sees in many stretches goes to pass 2 without being
sent more than once, so a passage of any frequency costs each task one row. Suffixes travel in packed, compressed blocks.
Texts move twice, compressed: to pass 2 (documents with open windows) and to be cut.

Defined results: null and empty texts have no windows; matches never cross documents; a document without an id counts
as larger than all others (equal to the largest id there can be) and matches none of its kind; rows of one id never match each other; long texts are taken in
pieces that overlap by WIDTH - 1 bytes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, mix64, partitions_for, utf8

WIDTH = 50
GRAM = 28
REACH = WIDTH - GRAM + 1  # anchors of a window lie at one of so many places
MER = 4 + (GRAM - 4) % REACH  # the modular minimizer's sample length
#: Suffixes that a task holds before it sends them, and bytes that it takes up at once.
HELD, PIECE = 1_000_000, 1 << 20
#: Stretches of one gram that a task sends; with more of them, all but one are settled in pass 2.
COMMON = 16
NO_ID = np.int64((1 << 63) - 1)
MOVED = "bucket int, kind int, n int, block binary, doc_id long, th long, spans array<int>"
BLOCK, REPEATED, OPEN = 0, 1, 2
FIELDS_1 = (("kh", "<u4"), ("c1", "<u4"), ("c2", "<u4"), ("s", "<u4"), ("n", "u1"), ("common", "u1"))
FIELDS_2 = (("h", "<u8"), ("g", "<u4"), ("s", "<u4"))
#: Bytes of text for each bucket of suffixes, which a task sorts in memory, and buckets that one exchange can have.
BUCKET_BYTES, MOST_BUCKETS = 32 << 20, 100_000

_TABLES = np.random.default_rng(20240101).integers(0, 1 << 64, (2, 256), dtype=np.uint64)


def pieces(at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, bounds, places): texts, or overlapping parts of long ones, with their bounds in the buffer and their first byte's place."""
    i, n, none = 0, len(at) - 1, np.zeros(1, np.int64)
    while i < n:
        size = at[i + 1] - at[i]
        if size > 4 * PIECE:
            for p in range(0, int(size) - WIDTH + 1, PIECE):
                yield np.array([i]), np.array([at[i] + p, min(at[i] + p + PIECE + WIDTH - 1, at[i + 1])]), none + p
            i += 1
            continue
        j = i + 1
        while j < n and at[j + 1] - at[i] <= PIECE and at[j + 1] - at[j] <= 4 * PIECE:
            j += 1
        yield np.arange(i, j), at[i : j + 1], np.zeros(j - i, np.int64)
        i = j


_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse."""
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, 1 << 16)
        _POWERS[:] = [
            np.concatenate(
                [np.ones(1, np.uint64), np.cumprod(np.full(n - 1, x & (1 << 64) - 1, np.uint64))]
            ) for x in (_BASE, pow(_BASE, -1, 1 << 64))
        ]
    return _POWERS[0], _POWERS[1]


def sums_of(data: np.ndarray, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial over the bytes modulo 2**64, and the factors that make differences of them place-free."""
    up, down = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLES[which][data] * up[: len(data)], out=out[1:])
    return out, down


def keys_at(sums: np.ndarray, down: np.ndarray, first: np.ndarray, size) -> np.ndarray:
    return mix64((sums[first + size] - sums[first]) * down[first] + np.asarray(size, np.uint64))


def stretches(data: np.ndarray, bounds: np.ndarray):
    """For each anchor: gram key, key of its stretch, number of the text, first window, number of windows."""
    at, total = bounds - bounds[0], int(bounds[-1] - bounds[0])
    x = total - WIDTH + 1
    if x < 1:
        return None
    sums, down = sums_of(data[bounds[0] : bounds[-1]])
    m = total - MER + 1
    best = (mix64((sums[MER:] - sums[:-MER]) * down[:m]) & np.uint64(0xFFFFFFFF00000000)) | np.arange(m, dtype=np.uint64)
    span, reach = 1, WIDTH - MER + 1
    while 2 * span <= reach:
        best, span = np.minimum(best[:-span], best[span:]), 2 * span
    if span < reach:
        best = np.minimum(best[: span - reach], best[reach - span :])
    start = np.arange(x)
    anchor = start + ((best & np.uint64(0xFFFFFFFF)).astype(np.int64) - start) % REACH
    first, last = at[:-1], at[1:] - WIDTH  # of each text's windows
    some = np.flatnonzero(last >= first)
    if not len(some):
        return None
    edge = np.zeros(x + 1, np.int32)
    np.add.at(edge, first[some], 1)
    np.add.at(edge, last[some] + 1, -1)
    inside = np.cumsum(edge[:x]) > 0
    new = np.zeros(x, bool)
    new[1:] = anchor[1:] != anchor[:-1]
    new[first[some]] = True
    new &= inside
    begin = np.flatnonzero(new)
    doc = np.searchsorted(at, begin, "right") - 1
    end = np.minimum(np.append(begin[1:], x), last[doc] + 1)
    n = end - begin
    return keys_at(sums, down, anchor[begin], GRAM), keys_at(sums, down, begin, n + WIDTH - 1), doc, begin - at[doc], n


def planes(column: np.ndarray, kind: str) -> bytes:
    """The bytes of all numbers, first bytes first: equal high bytes lie together and compress well."""
    return np.ascontiguousarray(column.astype(kind)).view(np.uint8).reshape(len(column), -1).T.tobytes()


def from_planes(raw: memoryview, at: int, n: int, kind: str) -> tuple[np.ndarray, int]:
    size = n * np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, size, at).reshape(-1, n).T).reshape(-1).view(kind), at + size


def packed(fields, columns: dict[str, np.ndarray]) -> bytes:
    """A compressed block of rows that are sorted by document: each run of a document names it once."""
    import zstandard

    cut = runs(columns["doc"], columns["th"])
    doc = columns["doc"][cut]
    parts = [
        np.array([len(cut)], "<u4").tobytes(), planes(np.diff(doc, prepend=0), "<i8"), planes(columns["th"][cut], "<i8"),
        planes(np.diff(np.append(cut, len(columns["doc"]))), "<u4")
    ]
    return zstandard.compress(b"".join(parts + [planes(columns[k], kind) for k, kind in fields]), 1)


def unpacked(fields, blocks: list[tuple[int, bytes]]) -> dict[str, np.ndarray]:
    import zstandard

    parts: dict[str, list[np.ndarray]] = {k: [] for k in ("doc", "th", *(k for k, _ in fields))}
    for n, block in blocks:
        raw = memoryview(zstandard.decompress(block))
        docs = int(np.frombuffer(raw, "<u4", 1)[0])
        doc, at = from_planes(raw, 4, docs, "<i8")
        th, at = from_planes(raw, at, docs, "<i8")
        count, at = from_planes(raw, at, docs, "<u4")
        parts["doc"].append(np.repeat(np.cumsum(doc), count))
        parts["th"].append(np.repeat(th, count))
        for k, kind in fields:
            column, at = from_planes(raw, at, n, kind)
            parts[k].append(column)
    return {k: np.concatenate(v) for k, v in parts.items()}


MOVED_SCHEMA = pa.schema(
    [
        ("bucket", pa.int32()), ("kind", pa.int32()), ("n", pa.int32()), ("block", pa.binary()), ("doc_id", pa.int64()), ("th", pa.int64()),
        ("spans", pa.list_(pa.int32()))
    ]
)


def block_rows(bucket: list[int], n: list[int], blocks: list[bytes]) -> pa.RecordBatch:
    k = len(n)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket, pa.int32()), pa.array([BLOCK] * k, pa.int32()), pa.array(n, pa.int32()), pa.array(blocks, pa.binary()),
            pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.list_(pa.int32()))
        ],
        schema=MOVED_SCHEMA
    )


def span_rows(kind: int, buckets: int, doc: np.ndarray, th: np.ndarray, s: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row for each document with its distinct (first, length) pairs: copies of one row add none."""
    order = np.lexsort((n, s, th, doc))
    order = order[runs(doc[order], th[order], s[order], n[order])] if len(order) else order
    doc, th, pairs = doc[order], th[order], np.stack([s[order], n[order]], 1).astype(np.int32)
    cut = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])])) if len(doc) else np.zeros(0, np.int64)
    spans = pa.ListArray.from_arrays(pa.array(np.append(cut, len(doc)) * 2, pa.int32()), pa.array(pairs.ravel(), pa.int32()))
    k = len(cut)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc[cut] % buckets, pa.int32()), pa.array(np.full(k, kind), pa.int32()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary()),
            pa.array(doc[cut], pa.int64()), pa.array(th[cut], pa.int64()), spans
        ],
        schema=MOVED_SCHEMA
    )


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys begin anew."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def send(fields, buckets: int, bucket: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((columns["s"], columns["th"], columns["doc"], bucket))
    bucket = bucket[order]
    cut = runs(bucket) if len(bucket) else np.zeros(0, np.int64)
    names, sizes, blocks = [], [], []
    for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(bucket)], strict=True):
        names.append(int(bucket[i]))
        sizes.append(j - i)
        blocks.append(packed(fields, {k: v[order[i:j]] for k, v in columns.items()}))
    if blocks:
        yield block_rows(names, sizes, blocks)


def gather_1(kh, ctx, doc, th, s, n, buckets: int) -> Iterator[pa.RecordBatch]:
    """Combine the suffixes a task holds: repeated and open stretches leave as spans, the others in blocks."""
    order = np.lexsort((doc, ctx, kh))
    kh, ctx, doc, th, s, n = (a[order] for a in (kh, ctx, doc, th, s, n))
    at = runs(kh, ctx)
    first = np.repeat(doc[at], np.diff(np.append(at, len(kh))))
    gone = doc > first
    if gone.any():
        yield span_rows(REPEATED, buckets, doc[gone], th[gone], s[gone], n[gone] + WIDTH - 1)
    kh, ctx, doc, th, s, n = (a[~gone] for a in (kh, ctx, doc, th, s, n))
    at = runs(kh)
    size = np.diff(np.append(at, len(kh)))
    many = np.repeat(size > COMMON, size)
    sent = ~many
    if many.any():
        yield span_rows(OPEN, buckets, doc[many], th[many], s[many], n[many])
        for i in at[size > COMMON].tolist():  # at most one in COMMON
            group = slice(i, i + int(size[np.searchsorted(at, i)]))
            sent[i + int(doc[group].argmin())] = True
    columns = {
        "kh": (kh >> np.uint64(32)), "c1": ctx & np.uint64(0xFFFFFFFF), "c2": ctx >> np.uint64(32),
        "doc": doc, "th": th, "s": s, "n": n, "common": many.astype(np.uint8)
    }
    bucket = (kh & np.uint64(0xFFFFFFFF)) % np.uint64(buckets)
    yield from send(FIELDS_1, buckets, bucket[sent].astype(np.int64), {k: v[sent] for k, v in columns.items()})


def _pass_1(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            ids, ths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, at = utf8(batch.column(2))
            for rows, bounds, places in pieces(at):
                found = stretches(data, bounds)
                if found is None:
                    continue
                kh, ctx, doc, s, n = found
                held.append((kh, ctx, ids[rows[doc]], ths[rows[doc]], s + places[doc], n))
                count += len(kh)
                if count > HELD:
                    yield from gather_1(*map(np.concatenate, zip(*held, strict=True)), buckets)
                    held, count = [], 0
        if held:
            yield from gather_1(*map(np.concatenate, zip(*held, strict=True)), buckets)

    return run


def settle_1(c: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Digits 1 and 2 of one bucket."""
    order = np.lexsort((c["doc"], c["c2"], c["c1"], c["kh"]))
    c = {k: v[order] for k, v in c.items()}
    at = runs(c["kh"])  # before rows go: a common gram's one row may be repeated itself
    c["open"] = np.repeat(np.maximum.reduceat(c["common"], at), np.diff(np.append(at, len(order))))
    at = runs(c["kh"], c["c1"], c["c2"])
    gone = c["doc"] > np.repeat(c["doc"][at], np.diff(np.append(at, len(order))))
    if gone.any():
        yield span_rows(REPEATED, 1, c["doc"][gone], c["th"][gone], c["s"][gone], c["n"][gone].astype(np.int64) + WIDTH - 1)
    c = {k: v[~gone] for k, v in c.items()}
    at = runs(c["kh"])
    size = np.diff(np.append(at, len(c["kh"])))
    low, high = np.minimum.reduceat(c["doc"], at), np.maximum.reduceat(c["doc"], at)
    left = (np.repeat(low < high, size) | (c["open"] > 0)) & (c["common"] == 0)
    if left.any():
        yield span_rows(OPEN, 1, c["doc"][left], c["th"][left], c["s"][left], c["n"][left])


def gather_2(h, g, doc, th, s, buckets: int) -> Iterator[pa.RecordBatch]:
    order = np.lexsort((doc, g, h))
    h, g, doc, th, s = (a[order] for a in (h, g, doc, th, s))
    at = runs(h, g)
    gone = doc > np.repeat(doc[at], np.diff(np.append(at, len(h))))
    if gone.any():
        yield span_rows(REPEATED, buckets, *joined(doc[gone], th[gone], s[gone]))
    keep = ~gone
    yield from send(
        FIELDS_2, buckets, (mix64(h[keep]) % np.uint64(buckets)).astype(np.int64),
        {"h": h[keep], "g": g[keep], "doc": doc[keep], "th": th[keep], "s": s[keep]}
    )


def joined(doc, th, s):
    """Spans (doc, th, first, bytes) that windows at the places ``s`` cover, neighbours joined."""
    order = np.lexsort((s, th, doc))
    doc, th, s = doc[order], th[order], s[order].astype(np.int64)
    new = np.ones(len(s), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (np.diff(s) > 1)
    cut = np.flatnonzero(new)
    last = s[np.append(cut[1:], len(s)) - 1]
    return doc[cut], th[cut], s[cut], last - s[cut] + WIDTH


def settle_2(c: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The whole depth of one bucket."""
    order = np.lexsort((c["doc"], c["g"], c["h"]))
    c = {k: v[order] for k, v in c.items()}
    at = runs(c["h"], c["g"])
    gone = c["doc"] > np.repeat(c["doc"][at], np.diff(np.append(at, len(order))))
    if gone.any():
        yield span_rows(REPEATED, 1, *joined(c["doc"][gone], c["th"][gone], c["s"][gone]))


def _settle(fields, rule):
    """Blocks sorted by bucket: a bucket at a time; spans go by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blocks = None, []
        for batch in batches:
            kinds = batch.column(1).to_numpy()
            if (kinds != BLOCK).any():
                yield batch.filter(pa.array(kinds != BLOCK))
            for i in np.flatnonzero(kinds == BLOCK).tolist():
                b = batch.column(0)[i].as_py()
                if b != bucket and blocks:
                    yield from rule(unpacked(fields, blocks))
                    blocks = []
                bucket = b
                blocks.append((batch.column(2)[i].as_py(), batch.column(3)[i].as_py()))
        if blocks:
            yield from rule(unpacked(fields, blocks))

    return run


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    z = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        data, at = utf8(batch.column(2))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), batch.column(3),
                pa.array([z.compress(data[i:j]) for i, j in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)], pa.binary())
            ],
            ["doc_id", "th", "none", "text"]
        )


def _grow(column: pa.Array) -> Iterator[np.ndarray]:
    import zstandard

    z = zstandard.ZstdDecompressor()
    for block in column:
        yield np.frombuffer(z.decompress(block.as_buffer()), np.uint8)


def _pass_2(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            ids, ths = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for k, data in enumerate(_grow(batch.column(2))):
                pairs = batch.column(3)[k].values.to_numpy().reshape(-1, 2).astype(np.int64)
                sizes = pairs[:, 1]
                s = np.unique(np.repeat(pairs[:, 0] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum()))
                for p in range(0, len(data), PIECE):
                    part = s[np.searchsorted(s, p) : np.searchsorted(s, p + PIECE)]
                    if len(part):
                        place = data[p : p + PIECE + WIDTH - 1]
                        h, g = (keys_at(*sums_of(place, which), part - p, WIDTH) for which in (0, 1))
                        held.append((h, (g >> np.uint64(32)).astype(np.uint32), np.full(len(part), ids[k]), np.full(len(part), ths[k]), part))
                        count += len(part)
                if count > HELD:
                    yield from gather_2(*map(np.concatenate, zip(*held, strict=True)), buckets)
                    held, count = [], 0
        if held:
            yield from gather_2(*map(np.concatenate, zip(*held, strict=True)), buckets)

    return run


def covered(n: int, spans: np.ndarray) -> np.ndarray:
    """Which of n bytes the (first, length) pairs cover."""
    edge = np.zeros(n + 1, np.int32)
    np.add.at(edge, spans[:, 0], 1)
    np.add.at(edge, spans[:, 0] + spans[:, 1], -1)
    return np.cumsum(edge[:n]) > 0


def _cut(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, texts = [], []
            for k, data in enumerate(_grow(batch.column(2))):
                spans = batch.column(3)[k]
                kept, gone, n = data, 0, 0
                if spans.is_valid:
                    mask = covered(len(data), spans.values.to_numpy().reshape(-1, 2))
                    kept, gone, n = data[~mask], int(mask.sum()), int((np.diff(mask.astype(np.int8), prepend=np.int8(0)) == 1).sum())
                out.append((len(data), gone, n, hashlib.sha256(kept).hexdigest()))
                texts.append(kept.tobytes() if keep_text else None)
            cols = list(zip(*out, strict=True)) or [[]] * 4
            none = batch.column(4).to_numpy(zero_copy_only=False)
            arrays = [pa.array(batch.column(0).to_numpy(), pa.int64(), mask=none), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(texts, pa.binary())] if keep_text else arrays, [*names, "kept_bytes"] if keep_text else names
            )

    return run


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_bytes, what is left, if ``keep_text``) of every row."""
    bounded_batches(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    parts = max(partitions_for(docs.sparkSession), min(MOST_BUCKETS, -(-size // BUCKET_BYTES)))
    # a row's spans are found again by its id and a hash of its text; of rows without an id, the hash alone must tell them apart
    none = F.col(doc_id).isNull()
    th = F.when(none, F.xxhash64(text)).otherwise(F.hash(text).cast("long").bitwiseAND(0xFFFFFFFF))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(int(NO_ID))).alias("doc_id"), th.alias("th"), F.col(text).alias("text"), none.alias("none"))
    small = rows.mapInArrow(_shrink, "doc_id long, th long, none boolean, text binary")
    moved = rows.mapInArrow(_pass_1(parts), MOVED).repartitionById(parts, "bucket").sortWithinPartitions("bucket")
    first = materialize(moved.mapInArrow(_settle(FIELDS_1, settle_1), MOVED).select("kind", "doc_id", "th", "spans"), "suffixes-1")

    def lists(frame: DataFrame) -> DataFrame:
        return materialize(frame.groupBy("doc_id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")

    still = lists(first.filter(f"kind = {OPEN}"))
    opened = small.join(still, ["doc_id", "th"]).select("doc_id", "th", "text", "spans")
    moved = opened.mapInArrow(_pass_2(parts), MOVED).repartitionById(parts, "bucket").sortWithinPartitions("bucket")
    second = moved.mapInArrow(_settle(FIELDS_2, settle_2), MOVED).select("doc_id", "th", "spans")
    repeated = lists(first.filter(f"kind = {REPEATED}").select("doc_id", "th", "spans").unionByName(second))
    names = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * keep_text
    return small.join(repeated, ["doc_id", "th"], "left").select("doc_id", "th", "text", "spans", "none").mapInArrow(_cut(keep_text), names)
