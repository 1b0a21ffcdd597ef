"""Near-duplicate embeddings by collision counting on many one-dimensional projections.

Lines are random directions in groups of LINES. In each group a vector lies on the line on which it is furthest out, on
that side: two vectors at a cosine of 0.9 share that line about half of the time, unrelated ones once in 2 * LINES. A list
is the vectors that share their lines in ``depth`` groups, sorted by where they lie on the first of these; the depth
follows from the number of vectors, so that unrelated ones hardly share lists, and the number of lists from the recall.
Only lists of several vectors are kept, before any vector is moved.

In a list each vector is the centre of a window over the sorted projections. For each pair in a window the collisions
over all groups are counted: both on the same line and there within the window's width. A pair counts where it reaches
a number of collisions that pairs at the least cosine miss with a chance stated by MISS, and is then verified in double
precision. Depth, lists, width and count are calibrated on pairs drawn at just that cosine, on the very lines. A pair is
counted in the first list that it shares, which both vectors' lines tell, so pairs are never rows: a list gives each
vector's links and one edge for each vector that is linked to an earlier one. Large lists are dealt to a group for each
pair of blocks. Components come from star contraction.

Equal vectors are one class with a size. Rows: null vectors, zero ones, and those with a null or non-finite entry link
with nothing; vectors of unlike lengths don't link. Null ids count as the largest; a component whose ids are all null has
a null id; repeated rows are copies that link with each other. Other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, broadcast_rows, join_groups, materialize, mix64, partitions_for
from .minhash_dedup import _grouped, _pairs, components, smallest_reached

LEAST_COSINE = 0.9
LINES = 64
#: A pair at the least cosine shares no list, or misses the count, with about this chance.
MISS = 1e-3
#: Half a window is five standard deviations of what lies between two vectors at the least cosine on a line; places are
#: counted in parts of that.
WIDTH = 64
STEP = 5 * math.sqrt(2 - 2 * LEAST_COSINE) / WIDTH
SEED = 11
#: Vectors of a list that meet in one group of rows; a larger list is dealt to a group for each pair of blocks.
BLOCK = 512
PAIRS_AT_ONCE = 16384
#: Lists for which a pair is dropped, before its collisions are counted, if it has met there.
EARLIER = 8
#: Lengths of vectors in one table.
MOST_LENGTHS = 1000


@dataclass(frozen=True)
class Plan:
    """What is fixed for vectors of one length: lists, the groups of each, and the least count of collisions."""

    dims: int
    lists: int
    depth: int
    least: int

    @property
    def groups(self) -> int:
        return self.lists * self.depth


@functools.lru_cache(8)
def lines(dims: int, groups: int) -> np.ndarray:
    """Directions (dims x groups * LINES); those of fewer groups are the first of more."""
    rng = np.random.default_rng([SEED, dims])
    return np.concatenate([rng.standard_normal((LINES, dims)).astype(np.float32) for _ in range(groups)]).T.copy()


def furthest(unit: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """For each unit vector and group the signed line on which it is furthest out, and where it lies on that (in STEPs)."""
    code, place = np.empty((len(unit), groups), np.uint8), np.empty((len(unit), groups), np.uint8)
    all_lines = lines(unit.shape[1], groups)
    for g in range(0, groups, 16):
        some = min(16, groups - g)
        at = (unit.astype(np.float32) @ all_lines[:, g * LINES : (g + some) * LINES]).reshape(len(unit), some, LINES)
        line = np.abs(at).argmax(axis=2)
        value = np.take_along_axis(at, line[:, :, None], 2)[:, :, 0]
        code[:, g : g + some] = line | np.where(value < 0, 128, 0)
        place[:, g : g + some] = np.minimum(np.abs(value) / STEP, 255)
    return code, place


@functools.lru_cache(64)
def calibrated(dims: int, vectors: int, cosine: float = LEAST_COSINE) -> Plan:
    """From pairs at exactly the least cosine: how often they collide, how far apart they lie, how many collisions they have."""
    depth = max(1, math.ceil(math.log(max(vectors, 2)) / math.log(2 * LINES) - 1e-9))
    rng = np.random.default_rng([SEED, dims, 1])
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in rng.standard_normal((2, 4096, dims)))
    across = b - (a * b).sum(axis=1, keepdims=True) * a
    norm = np.linalg.norm(across, axis=1, keepdims=True)
    b = cosine * a + math.sqrt(1 - cosine**2) * np.divide(across, norm, out=np.zeros_like(across), where=norm > 1e-9)
    (x, p), (y, q) = furthest(a, 32), furthest(b, 32)
    rate = float(collide(x, p, y, q).mean())
    lists = max(1, math.ceil(math.log(MISS / 2) / math.log1p(-min(rate**depth, 1 - 1e-9))))
    groups, least = lists * depth, 0
    missed = 0.0
    while least < groups:  # the largest count that a pair misses with at most half of MISS
        ways = math.lgamma(groups + 1) - math.lgamma(least + 1) - math.lgamma(groups - least + 1)
        missed += math.exp(ways + least * math.log(rate) + (groups - least) * math.log1p(-min(rate, 1 - 1e-9)))
        if missed > MISS / 2:
            break
        least += 1
    return Plan(dims, lists, depth, least)


def collide(x: np.ndarray, p: np.ndarray, y: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Where (lines x, places p) and (lines y, places q) are on one line and there within a window."""
    return (x == y) & (np.maximum(p, q) - np.minimum(p, q) <= WIDTH)


def list_keys(code: np.ndarray, plan: Plan) -> np.ndarray:
    """64-bit keys (vectors x lists) of the lists that vectors are in."""
    c = code.reshape(len(code), plan.lists, plan.depth)
    h = np.broadcast_to(np.arange(1, plan.lists + 1, dtype=np.uint64) + np.uint64(plan.dims << 32), c.shape[:2])
    for d in range(plan.depth):
        h = mix64(h * np.uint64(0xD6E8FEB86659FD93) + c[:, :, d])
    return h


def unit_vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors in double precision), by length, of those that have a direction."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for dims in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == dims)
        x = flat[starts[rows][:, None] + np.arange(dims)]
        largest = np.abs(x).max(axis=1)
        good = np.isfinite(largest) & (largest > 0)
        rows, x = rows[good], x[good] / largest[good, None]
        yield rows, x / np.linalg.norm(x, axis=1, keepdims=True)


def lister(plans: dict[int, Plan]):
    """Rows (v, vector): (v, keys of its lists, lines, places)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                units = [np.frombuffer(x, np.float64) for x in part.column(1).to_pylist()]
                sizes = np.array([len(x) for x in units])
                for dims in np.unique(sizes).tolist():
                    rows = np.flatnonzero(sizes == dims)
                    plan = plans[dims]
                    code, place = furthest(np.stack([units[r] for r in rows]), plan.groups)
                    ends = pa.array(np.arange(0, len(rows) * plan.lists + 1, plan.lists, dtype=np.int32))
                    keys = pa.ListArray.from_arrays(ends, pa.array(list_keys(code, plan).view(np.int64).ravel()))
                    sketch = [pa.array([x.tobytes() for x in part_], pa.binary()) for part_ in (code, place)]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), keys, *sketch], ["v", "keys", "code", "place"])

    return run


def met_pairs(plan: Plan, t: int, side: np.ndarray, code: np.ndarray, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of list ``t``, sorted by their place on its first line, that collide often enough and met in no list before."""
    first = place[:, t * plan.depth].astype(np.int64)
    order = np.argsort(first, kind="stable")
    ends = np.searchsorted(first[order], first[order] + WIDTH, "right")
    across = bool(side.any()) and not bool(side.all())
    heads = place[:, :: plan.depth].T.copy()
    lines_of = np.zeros((plan.lists, len(code)), np.uint64)  # of each list a vector's lines as one number (up to 8 groups)
    for d in range(plan.depth):
        lines_of = lines_of << np.uint64(8) | code[:, d :: plan.depth].T
    begin = 0
    while begin < len(order):  # windows over the sorted places, some pairs at a time
        stop = begin + max(1, int(np.searchsorted(np.cumsum(ends[begin:] - np.arange(begin, len(order)) - 1), PAIRS_AT_ONCE)))
        centre = np.arange(begin, min(stop, len(order)))
        n = ends[centre] - centre - 1
        i = np.repeat(centre, n)
        j = i + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        i, j, begin = order[i], order[j], stop
        if across:
            i, j = i[side[i] != side[j]], j[side[i] != side[j]]
        for before in range(min(t, EARLIER)):  # most pairs of a dense cloud met in one of the first lists
            new = ~collide(lines_of[before, i], heads[before, i], lines_of[before, j], heads[before, j])
            i, j = i[new], j[new]
        same = collide(code[i], place[i], code[j], place[j])
        often = same.sum(axis=1) >= plan.least
        i, j, same = i[often], j[often], same[often]
        if len(i):
            # a list is shared where all its lines are and the places on the first are within the width
            shared = (code[i] == code[j]).reshape(len(i), plan.lists, plan.depth).all(axis=2) & same[:, :: plan.depth]
            new = shared.argmax(axis=1) == t
            yield i[new], j[new]


def linker(plans: dict[int, Plan]):
    """Rows (key, i, j, side, v, t, size, unit, code, place), sorted by group: v's links n (p null), or an edge (v, p)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _grouped(batches, 10):
            side, v, t, size = (np.array(x) for x in zip(*(h[:4] for h in held), strict=True))
            unit = np.frombuffer(b"".join(h[4] for h in held), np.float64).reshape(len(held), -1)
            code, place = (np.frombuffer(b"".join(h[k] for h in held), np.uint8).reshape(len(held), -1) for k in (5, 6))
            plan = plans[unit.shape[1]]
            links, n = np.zeros((len(held), len(held)), bool), np.zeros(len(held), np.int64)
            for i, j in met_pairs(plan, int(t[0]), side, code, place):
                near = np.einsum("ij,ij->i", unit[i], unit[j]) >= LEAST_COSINE
                i, j = i[near], j[near]
                links[i, j] = links[j, i] = True
                np.add.at(n, i, size[j])
                np.add.at(n, j, size[i])
            some = np.flatnonzero(n)
            if len(some):
                label = smallest_reached(links)
                at = np.flatnonzero(label != np.arange(len(label)))
                yield pa.RecordBatch.from_arrays([pa.array(v[some]), pa.nulls(len(some), pa.int64()), pa.array(n[some])], ["v", "p", "n"])
                edges = _pairs(v[label[at]].tolist(), v[at].tolist())
                yield pa.RecordBatch.from_arrays([edges.column(1), edges.column(0), pa.nulls(len(at), pa.int64())], ["v", "p", "n"])

    return run


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vec_id, vector): (vec_id, length, unit vector as bytes); both null if it has no direction."""
    for batch in batches:
        for i in range(0, batch.num_rows, 4096):
            part = batch.slice(i, 4096)
            dims, unit = np.zeros(part.num_rows, np.int64), np.full(part.num_rows, None, object)
            for rows, x in unit_vectors(part.column(1)):
                dims[rows] = x.shape[1]
                unit[rows] = [r.tobytes() for r in x + 0.0]  # no negative zeros
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(dims, mask=dims == 0), pa.array(unit, pa.binary())], ["vec_id", "dims", "unit"])


def dealt(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (key, i, j, side, v, t, size, unit, code, place): the members of each list, in a group for each pair of its blocks."""
    block = F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    own = lists.withColumn("b", block).withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meets = own.select("key", F.least("b", "x").alias("i"), F.greatest("b", "x").alias("j"), (F.col("b") > F.col("x")).cast("int").alias("side"), "v", "t")
    rows = meets.join(classes, "v").select("key", "i", "j", "side", "v", "t", "size", "unit", "code", "place")
    return rows.repartition(partitions_for(rows.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j")


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    units = materialize(rows.mapInArrow(_units, "vec_id long, dims long, unit binary"), "units")
    classes = units.filter("unit is not null").groupBy("unit").agg(F.first("dims").alias("dims"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"))
    classes = materialize(classes.withColumn("v", F.monotonically_increasing_id()), "classes")
    counts = broadcast_rows(classes.groupBy("dims").count(), MOST_LENGTHS, "lengths of vectors")
    plans = {r["dims"]: calibrated(r["dims"], 1 << max(0, r["count"] - 1).bit_length()) for r in counts}
    sketch = classes.select("v", "unit").mapInArrow(lister(plans), "v long, keys array<long>, code binary, place binary")
    keys = materialize(sketch, "keys")
    listed = keys.select("v", F.posexplode("keys").alias("t", "key"))
    several = materialize(listed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "lists")
    several = several.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    members = join_groups(listed, several, ["key"], "n").select("key", "v", "t", "blocks")
    wanted = classes.select("v", "size", "unit").join(keys.select("v", "code", "place"), "v")
    found = materialize(dealt(members, wanted).mapInArrow(linker(plans), "v long, p long, n long"), "vector-links")
    links = found.filter("p is null").groupBy("v").agg(F.sum("n").alias("linked"))
    tops = components(found.filter("p is not null").select("p", "v"))
    named = classes.select("v", "unit", "least", "size").join(tops, "v", "left").withColumn("c", F.coalesce("c", "v")).join(links, "v", "left")
    named = materialize(named, "vector-components")
    first = named.groupBy("c").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("members"))
    each = join_groups(named, materialize(first, "firsts"), ["c"], "members")
    each = materialize(each.select("unit", "size", "component_id", (F.col("size") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")), "named-vectors")
    good = join_groups(units.filter("unit is not null"), each, ["unit"], "size").select("vec_id", "n_links", "component_id")
    alone = units.filter("unit is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
