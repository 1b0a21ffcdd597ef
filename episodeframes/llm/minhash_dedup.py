"""Near-duplicates by fast similarity sketching, banding, exact verification and connected components.

Sketch: round i of 2 * COORDINATES throws every shingle of a set into a bin (a hashed bin in the first COORDINATES
rounds, bin i - COORDINATES after them, which fills the last ones) with the value (i, hash); a bin keeps its least value,
so a bin that an earlier round filled is final and a round only looks at sets with empty bins. Each coordinate then agrees
between two sets with the probability of their similarity, with concentration as for independent minima, in expected time
O(n + k log k) (Dahlgaard, Knudsen, Thorup 2017). Bands of ROWS coordinates are hashed: two sets of similarity 0.75
share one of BANDS bands but for 7 in a million.

Links: equal sets are one node. In each band bucket every node meets the bucket's first node; a node is first compared
with the smallest of those alone, whole sets against whole sets, streamed by pivot, and hot pivots are salted. Nodes that
this connects need no further comparison with each other. All others that share a bucket but no component meet in blocks
of BLOCK nodes, as one byte of each coordinate; fewer than LEAST_AGREE agreeing bytes mean dissimilar (five standard
deviations below 0.75). What may be similar forms clusters, and within a cluster all pairs of two components are compared
on whole sets, again in blocks of bounded size, each of which merges what it links as it goes. Nodes of the largest
component of a bucket or cluster, however many, only meet the others. Hashes find the shingles that two texts share; a
link counts only where their words are equal as bytes. So no link between components is lost, pairs are never rows, and
a large group of near copies is mostly done when its first comparison is. Components come from star contraction in
Spark; nothing is collected.

Defined results: a text of no words has an empty set and stays by itself; nulls in doc_id count as the largest ids;
repeated rows are copies, of which ``drop_near_copies`` keeps one. Other columns are carried.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, bounded_batches, join_groups, keyed, materialize, mix64, partitions_for, positional, row_blocks, run_hashes, utf8

BANDS, ROWS = 44, 5
COORDINATES = BANDS * ROWS
SHINGLE = 5
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Members of a pivot that meet in one group of rows; a larger group is dealt to more.
MEMBERS = 256
#: Nodes of a bucket that meet in one group of rows; a larger bucket is dealt to a group for each pair of blocks.
BLOCK = 512
#: Bytes of text that a block holds; blocks of long texts have fewer nodes.
BLOCK_TEXT = 8 << 20
#: Keys (16 bytes) of documents that don't simply stay, up to which they are broadcast.
MOST_ODD = 1_000_000
LEAST_AGREE = int(COORDINATES * 0.75 - 5 * (COORDINATES * 0.75 * 0.25) ** 0.5)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
#: The same separators for a regular expression: whether a text has a word.
HAS_WORD = r"[^\x20\x09-\x0D]"
SIGNATURES = "doc_id long, k1 long, k2 long, n_shingles long, node binary, bands array<long>, sig binary"


@dataclass
class Shingles:
    """The distinct shingles of a text: sorted hashes, the word where each first begins, and the words' bytes."""

    hashes: np.ndarray
    at: np.ndarray
    width: int
    first: np.ndarray
    last: np.ndarray
    data: np.ndarray


def words_of(low: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last) bytes of the words of all texts ``low[at[i]:at[i + 1]]``, and the n + 1 bounds of the texts in them."""
    word = ~SEPARATOR[low]
    start, stop = word.copy(), word.copy()
    start[1:] &= ~word[:-1]
    stop[:-1] &= ~word[1:]
    inner = at[1:-1][at[1:-1] < len(low)]
    start[inner] = word[inner]
    inner = at[1:-1][at[1:-1] > 0] - 1
    stop[inner] = word[inner]
    first, last = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return first, last, np.searchsorted(first, at)


def chained(words: np.ndarray, width: int) -> np.ndarray:
    h = np.full(max(0, len(words) - width + 1), width, np.uint64)
    for k in range(width):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[k : k + len(h)]
    return mix64(h)


def shingled(data: np.ndarray, at: np.ndarray, places: bool = True) -> Iterator[Shingles]:
    """The shingles of each text (bytes ``data[at[i]:at[i + 1]]``); ``places`` only where bytes are to be compared."""
    low, at = np.frombuffer(data[at[0] : at[-1]].tobytes().translate(LOWER), np.uint8), at - at[0]
    first, last, bounds = words_of(low, at)
    words = run_hashes(low, first, last)
    whole, none = chained(words, SHINGLE), np.zeros(0, np.int64)
    for i, j in itertools.pairwise(bounds.tolist()):
        width = min(SHINGLE, j - i)
        h = whole[i : j - SHINGLE + 1] if width == SHINGLE else chained(words[i:j], width) if width else words[:0]
        hashes, begin = np.unique(h, return_index=True) if places else (np.unique(h), none)
        yield Shingles(hashes, begin, width, first[i:j], last[i:j], low)


def shingle_sets(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    return [s.hashes for s in shingled(data, at, places=False)]


def sketches(sets: list[np.ndarray], k: int = COORDINATES) -> np.ndarray:
    """A row of k coordinates for each set; those of an empty set stay EMPTY."""
    sizes = np.array([len(s) for s in sets], np.int64)
    out = np.full(len(sets) * k, EMPTY, np.uint64)
    x, owner = np.concatenate([np.zeros(0, np.uint64), *sets]), np.repeat(np.arange(len(sets)), sizes)
    for i in range(2 * k):
        h = mix64(x ^ mix64(np.array([i + 1], np.uint64)))
        bins = ((h >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64) if i < k else np.full(len(x), i - k)
        at = owner * k + bins
        value = np.uint64(i) << np.uint64(54) | h & np.uint64((1 << 54) - 1)
        if i:
            free = out[at] == EMPTY
            at, value = at[free], value[free]
        np.minimum.at(out, at, value)
        hungry = (out.reshape(-1, k) == EMPTY).any(axis=1)[owner]
        x, owner = x[hungry], owner[hungry]
        if not len(x):
            break
    return out.reshape(-1, k)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """64-bit keys (sets x BANDS); the number of a band is part of its keys."""
    s = sketch.reshape(len(sketch), BANDS, ROWS)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), s.shape[:2])
    for r in range(ROWS):
        h = mix64(h * np.uint64(0xD6E8FEB86659FD93) + s[:, :, r])
    return h


def same_words(a: Shingles, i: np.ndarray, b: Shingles, j: np.ndarray) -> np.ndarray:
    """Whether the words ``i`` of one text and ``j`` of another are equal, byte by byte."""
    size = a.last[i] - a.first[i]
    same = size == b.last[j] - b.first[j]
    i, j, size = a.first[i[same]], b.first[j[same]], size[same]
    if len(size):
        starts = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(starts, size)
        equal = a.data[np.repeat(i, size) + place] == b.data[np.repeat(j, size) + place]
        same[same] = np.logical_and.reduceat(equal, starts)
    return same


def similar(a: Shingles, b: Shingles) -> bool:
    """Whether two texts are linked. Hashes find the shingles that both have; their words are then compared as bytes."""
    n, m = len(a.hashes), len(b.hashes)
    if a.width != b.width or 100 * min(n, m) < PERCENT * max(n, m):
        return False
    both, i, j = np.intersect1d(a.hashes, b.hashes, assume_unique=True, return_indices=True)
    if 100 * len(both) < PERCENT * (n + m - len(both)):
        return False
    step = np.arange(a.width)
    i, j = (a.at[i][:, None] + step).ravel(), (b.at[j][:, None] + step).ravel()
    pairs, back = np.unique(i << 32 | j, return_inverse=True)
    same = same_words(a, pairs >> 32, b, pairs & 0xFFFFFFFF)
    equal = int(same[back].reshape(-1, a.width).all(axis=1).sum())
    return 100 * equal >= PERCENT * (n + m - equal)


def node_key(s: Shingles) -> bytes:
    """128 bits for equal sets: of all hashes, or of the words themselves where there is one shingle only."""
    own = s.hashes.tobytes()
    if len(s.hashes) == 1:
        words = zip(s.first[: s.width].tolist(), s.last[: s.width].tolist(), strict=True)  # any place has the same words
        own = b" ".join(s.data[i:j].tobytes() for i, j in words)
    return hashlib.blake2b(own, digest_size=16).digest()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, at = utf8(batch.column(3))
        for i, j in row_blocks(at):
            texts = list(shingled(data, at[i : j + 1], places=False))
            sets = [s.hashes for s in texts]
            sketch = sketches(sets)
            keys, sig = band_keys(sketch).view(np.int64), sketch.astype(np.uint8)
            nodes = [node_key(s) if s.width else None for s in texts]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (j - i + 1) * BANDS, BANDS, dtype=np.int32)), pa.array(keys.ravel()))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).slice(i, j - i) for c in range(3)), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.binary()),
                    lists, pa.array([x.tobytes() for x in sig], pa.binary())
                ],
                ["doc_id", "k1", "k2", "n_shingles", "node", "bands", "sig"]
            )


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (p, salt, member, v, text), sorted: each pivot's own row comes before its members."""
    pivot, base = None, None
    for batch in batches:
        data, at = utf8(batch.column(4))
        cols = [batch.column(c).to_pylist() for c in range(4)]
        for i, j in row_blocks(at):
            found = []
            for k, s in zip(range(i, j), shingled(data, at[i : j + 1]), strict=True):
                if not cols[2][k]:
                    pivot, base = (cols[0][k], cols[1][k]), s
                else:
                    if pivot != (cols[0][k], cols[1][k]):
                        raise ValueError("members without their pivot")
                    if similar(base, s):
                        found.append((cols[0][k], cols[3][k]))
            if found:
                p, v = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(v, pa.int64())], ["p", "v"])


def may_link(c: np.ndarray, side: np.ndarray, sig: np.ndarray) -> np.ndarray:
    """Matrix of nodes of different components whose signatures agree enough; if there are two sides, only across."""
    out = np.zeros((len(c), len(c)), bool)
    for i in range(0, len(c), 64):
        out[i : i + 64] = (sig[i : i + 64, None, :] == sig[None, :, :]).sum(axis=2) >= LEAST_AGREE
    out &= c[:, None] != c[None, :]
    return out & (side[:, None] != side[None, :]) if side.any() and not side.all() else out


def smallest_reached(links: np.ndarray) -> np.ndarray:
    """For each node of a symmetric matrix of links the smallest node it reaches."""
    label = np.arange(len(links))
    while True:
        new = np.minimum(label, np.where(links, label[None, :], len(links)).min(axis=1, initial=len(links)))
        if (new == label).all():
            return label
        label = new


def _grouped(batches: Iterator[pa.RecordBatch], width: int):
    """Lists of rows (without their first three columns, the group) of sorted batches."""
    group, held = None, []
    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            part = batch.slice(i, 256)
            for row in zip(*(part.column(x).to_pylist() for x in range(width)), strict=True):
                if row[:3] != group:
                    if len(held) > 1:
                        yield held
                    group, held = row[:3], []
                held.append(row[3:])
    if len(held) > 1:
        yield held


def _pairs(p: list[int], v: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(v, pa.int64())], ["p", "v"])


def _columns(held: list[tuple]) -> tuple[np.ndarray, ...]:
    side, v, c = (np.array(x) for x in zip(*(h[:3] for h in held), strict=True))
    return side, v, c, np.frombuffer(b"".join(h[3] for h in held), np.uint8).reshape(len(held), COORDINATES)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, i, j, side, v, c, sig), sorted by group: what may be linked, as one edge for each node."""
    for held in _grouped(batches, 7):
        side, v, c, sig = _columns(held)
        label = smallest_reached(may_link(c, side, sig))
        at = np.flatnonzero(label != np.arange(len(label)))
        if len(at):
            yield _pairs(v[label[at]].tolist(), v[at].tolist())


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (cluster, i, j, side, v, c, sig, text), sorted by group: links that join different components."""
    for held in _grouped(batches, 8):
        side, v, c, sig = _columns(held)
        sets = list(shingled(*utf8(pa.array([h[4] for h in held], pa.string()))))
        up = {x: x for x in c.tolist()}

        def top(x):
            while up[x] != x:
                up[x] = x = up[up[x]]
            return x

        p, q = [], []
        for x, y in np.argwhere(np.triu(may_link(c, side, sig))).tolist():
            a, b = top(int(c[x])), top(int(c[y]))
            if a != b and similar(sets[x], sets[y]):
                up[max(a, b)] = min(a, b)
                p.append(int(v[x]))
                q.append(int(v[y]))
        if p:
            yield _pairs(p, q)


def block_counts(rows: DataFrame, key: str, name: str, room) -> DataFrame:
    """For each key with more than one component: its largest component (top) and the blocks of that (big) and of the rest.

    ``room`` is an aggregate: the blocks that some rows fill. Only a row for each (key, component) is grouped by key.
    """
    each = rows.groupBy(key, "c").agg(F.count(F.lit(1)).alias("n"), room.alias("room"))
    top = F.max(F.struct("n", "c", "room"))
    both = each.groupBy(key).agg(top.alias("top"), F.sum("room").alias("room"), F.count(F.lit(1)).alias("components"))
    rest = F.ceil(F.col("room") - F.col("top.room") + 1e-9)
    counted = both.filter("components > 1").select(
        key, F.col("top.c").alias("top"), F.ceil("top.room").cast("int").alias("big"), rest.cast("int").alias("rest")
    )
    return materialize(counted, name)


def with_blocks(rows: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Rows with the blocks of their key; keys of many rows, as their blocks show, are joined apart."""
    return join_groups(rows, blocks.withColumn("_rows", (F.col("big") + F.col("rest")) * BLOCK), [key], "_rows").drop("_rows")


def in_blocks(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows (with top, big and rest of their key) dealt to a group (key, i, j) for each pair of blocks that may hold links.

    Nodes of the key's largest component need not meet each other: they go once to each block of the rest, whatever
    their number. The rest's blocks meet each other and those.
    """
    large, spread = F.col("c") == F.col("top"), F.xxhash64("v")
    block = F.when(large, F.col("rest") + F.pmod(spread, F.col("big"))).otherwise(F.pmod(spread, F.col("rest"))).cast("int")
    last = F.when(large, F.col("rest")).otherwise(F.col("rest") + F.col("big")) - 1
    own = rows.withColumn("b", block).withColumn("x", F.explode(F.sequence(F.lit(0), last)))
    meets = own.select(
        key, F.least("b", "x").alias("i"), F.greatest("b", "x").alias("j"), (F.col("b") > F.col("x")).cast("int").alias("side"), *columns
    )
    return meets.repartition(partitions_for(rows.sparkSession), key, "i", "j").sortWithinPartitions(key, "i", "j")


def crossing_links(placed: DataFrame, found: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (p, v) between components of nodes that share a bucket. ``placed``: (key, v, c), ``found``: (v, c)."""
    blocks = block_counts(placed, "key", "mixed", F.count(F.lit(1)) / BLOCK)
    mixed = with_blocks(placed, blocks, "key").join(nodes.select("v", "sig"), "v")
    edges = in_blocks(mixed, "key", ["v", "c", "sig"]).mapInArrow(_candidates, "p long, v long")
    clusters = materialize(components(edges).withColumnRenamed("c", "cluster"), "clusters")
    members = clusters.join(found, "v", "left").withColumn("c", F.coalesce("c", "v")).join(texts, "v").join(nodes.select("v", "sig"), "v")
    members = materialize(members, "cluster-members")
    room = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum(F.octet_length("text")) / BLOCK_TEXT)
    blocks = block_counts(members, "cluster", "cluster-sizes", room)
    dealt = in_blocks(with_blocks(members, blocks, "cluster"), "cluster", ["v", "c", "sig", "text"])
    return dealt.mapInArrow(_compared, "p long, v long").distinct()


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the distinct pairs (p, v) whose whole sets are similar. ``texts``: (v, text)."""
    spark = pairs.sparkSession
    salts = pairs.groupBy("p").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("salts"))
    salts = materialize(salts, "pivots")
    members = pairs.join(salts, "p").withColumn(
        "salt", F.pmod(F.xxhash64("v"), F.col("salts")).cast("int")
    ).join(texts, "v").select("p", "salt", F.lit(True).alias("member"), "v", "text")
    own = salts.select("p", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")).join(texts.withColumnRenamed("v", "p"), "p").select(
        "p", "salt", F.lit(False).alias("member"), F.col("p").alias("v"), "text"
    )
    dealt = members.unionByName(own).repartition(partitions_for(spark), "p", "salt").sortWithinPartitions("p", "salt", "member")
    return materialize(dealt.mapInArrow(_links, "p long, v long").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """(v, c) for every node with a link: c is the smallest node of its component.

    Stars are contracted until all are stars around a smallest node, which the counts of smaller and larger neighbours
    show. Rows of a hub are not joined in one task.
    """
    edges = materialize(links.select(F.greatest("p", "v").alias("a"), F.least("p", "v").alias("b")).filter("a != b").distinct(), "edges")
    while True:
        down = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
        counts = (F.count_if(F.col("b") < F.col("a")).alias("below"), F.count_if(F.col("b") > F.col("a")).alias("above"))
        least = edges.unionByName(down).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), *counts)
        least = materialize(least, "large-stars")
        if not least.filter("below > 1 or (below > 0 and above > 0)").limit(1).collect():
            break
        met = join_groups(down, least.filter("above > 0"), ["a"], "above")
        large = materialize(met.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")), "small-stars")
        both = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = join_groups(large, least, ["a"], "n").select(F.explode(both).alias("e")).select("e.a", "e.b").filter("a != b")
        edges = materialize(small.distinct(), "edges")
    stars = edges.select(F.col("a").alias("v"), F.col("b").alias("c"))
    return stars.unionByName(least.filter("above > 0").select(F.col("a").alias("v"), F.col("a").alias("c")))


def placed_in(members: DataFrame, found: DataFrame) -> DataFrame:
    """(key, v, c): bucket, node and its component so far."""
    return materialize(members.select("key", "v").join(found, "v", "left").select("key", "v", F.coalesce("c", "v").alias("c")), "placed")


def near_groups(docs: DataFrame) -> DataFrame:
    """``docs``: doc_id, text, k1, k2. Returns doc_id, k1, k2, n_shingles, component_id, first_id, first_k1, first_k2.

    The last three name the document that stands for its component; they are null for empty sets.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", "k1", "k2", "text")
    signed = materialize(rows.mapInArrow(_signatures, SIGNATURES), "signatures")
    # null ids last
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    nodes = signed.filter("node is not null").groupBy("node").agg(
        F.min(order).alias("rep"), F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("copies")
    )
    nodes = materialize(nodes.withColumn("v", F.monotonically_increasing_id()), "nodes")
    banded = nodes.select("v", F.explode("bands").alias("key"))
    buckets = materialize(
        banded.groupBy("key").agg(F.min("v").alias("p"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets"
    )
    members = materialize(join_groups(banded, buckets, ["key"], "n").select("key", "v", "p"), "members")
    wanted = members.select("v").distinct().join(nodes.select("v", "rep.k1", "rep.k2"), "v")
    texts = materialize(rows.select("k1", "k2", "text").join(wanted, ["k1", "k2"]).groupBy("v").agg(F.first("text").alias("text")), "texts")
    nearest = materialize(members.filter("v != p").groupBy("v").agg(F.min("p").alias("p")).select("p", "v"), "pairs")
    links = verified(nearest, texts)
    found = materialize(components(links), "components")
    # all other pairs that share a bucket and no component
    more = crossing_links(placed_in(members, found), found, nodes, texts)
    found = materialize(components(found.select(F.col("c").alias("p"), "v").unionByName(more)), "components")
    tops = nodes.select("v", "node", "rep", "copies").join(found, "v", "left").select("node", "rep", "copies", F.coalesce("c", "v").alias("c"))
    tops = materialize(tops, "tops")
    first = materialize(tops.groupBy("c").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("sets")), "firsts")
    named = materialize(join_groups(tops.select("node", "copies", "c"), first, ["c"], "sets").select("node", "copies", "first"), "named")
    signed = signed.drop("bands", "sig")
    told = join_groups(signed.filter("node is not null"), named, ["node"], "copies").drop("copies")
    empty = signed.filter("node is null").withColumn("first", F.lit(None).cast(named.schema["first"].dataType))
    return told.unionByName(empty).select(
        "doc_id", "k1", "k2", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.col("first.doc_id").alias("first_id"), F.col("first.k1").alias("first_k1"), F.col("first.k2").alias("first_k2"),
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    groups = near_groups(keyed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", "text"))
    return groups.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """One document of each group, with its columns unchanged; documents without words all stay."""
    renamed, names = positional(docs)
    doc_id, text = f"_{names.index('doc_id')}", f"_{names.index('text')}"
    rows = keyed(renamed, doc_id, text)
    groups = near_groups(rows.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), "k1", "k2"))
    first = F.bool_or((F.col("k1") == F.col("first_k1")) & (F.col("k2") == F.col("first_k2"))).alias("first")
    keys = groups.filter("first_k1 is not null").groupBy("k1", "k2").agg(first, F.count(F.lit(1)).alias("n"))
    # what goes, and what is there several times; mostly that is little, and then no text moves
    odd = materialize(keys.filter("not first or n > 1"), "odd-keys")
    has_words = F.coalesce(F.col(text).rlike(HAS_WORD), F.lit(False))
    worded, key = rows.filter(has_words), ["k1", "k2"]
    few = odd.limit(MOST_ODD + 1).count() <= MOST_ODD
    side = F.broadcast if few else (lambda df: df)
    several = worded.join(side(odd.filter("first").select(*key)), key, "left_semi").dropDuplicates(key)
    out = worded.join(side(odd.select(*key)), key, "left_anti").unionByName(several).unionByName(rows.filter(~has_words))
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(names)))
