"""Ranked lexical search over compressed quadtrees (K2-treaps) of the term-document grid.

Statistics come first, over all documents: how many hold a term, their terms, and each query term's documents. Then every
task takes its documents in blocks and builds a K2-treap of each block's grid: a row for each term of the block, a column
for each document. Only cells that hold something are stored, level by level: four bits a cell say which quarters are not
empty, a rank over the bits is where a quarter's cell is, and each cell has the largest impact inside it. An impact is
what an occurrence adds to a score before the term's weight, so it depends on the document and on totals alone.

An item descends in the grid with one path for each of its terms, all in the same range of documents: the sum of weight
times maximum over its paths bounds what any document of the range can score. Ranges are taken best first and split in
halves; a range of one document has its exact score. A range whose bound is below the item's worst kept score cannot
change the result and is not opened. What is kept for an item carries over to the task's next blocks. The best of all
tasks meet in two steps, so a task's share of them doesn't grow with the number of tasks.

Defined results: a document without terms or text is never returned and counts in no statistic; an item without terms
returns nothing; terms that no document has add nothing. Equal scores are ordered by doc_id, null ids last. Repeated
document rows are each ranked; rows of items that agree in id and text are one item, and texts that share an id are each
answered under it. Other columns are ignored. A text of any length is taken in pieces.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, bounded_batches, materialize, row_blocks, utf8

TOP = 50
#: The query set meets the index so many items and (at least one item) query terms at once; all tasks hold those.
ITEMS_AT_ONCE, TERMS_AT_ONCE = 1000, 200_000
#: Text of the documents of one grid. A longer document is alone in its grid.
GRID_BYTES = 4 << 20
#: A document is split into terms in pieces of so many bytes.
PIECE_BYTES = 1 << 20
#: Distinct terms for which a task counts documents before it hands on what it has.
COUNTED_TERMS = 200_000
#: Paths that one step of a descent follows: document ranges x terms.
PATHS_A_STEP = 8192
#: What all tasks have kept of an item meets in so many groups before it meets in one.
GROUPS = 32
TERM = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
NOT_TERM = re.compile(rb"[^0-9A-Za-z\x80-\xFF]")


def counted(text: bytes) -> Counter:
    """How often each term occurs in a text (UTF-8)."""
    low, found, i = text.translate(LOWER), Counter(), 0
    while i < len(low):
        cut = NOT_TERM.search(low, i + PIECE_BYTES) if len(low) - i > PIECE_BYTES else None
        j = cut.start() if cut else len(low)
        found.update(TERM.findall(low, i, j))
        i = j
    return found


def _texts(column: pa.Array, i: int, j: int) -> Iterator[bytes]:
    data, at = utf8(column)
    return (data[at[k] : at[k + 1]].tobytes() for k in range(i, j))


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (term, documents, tokens): of each term the documents that hold it; of no term (null) all documents and tokens."""
    documents, tokens, seen = 0, 0, Counter()

    def rows(seen: Counter, documents: int, tokens: int) -> pa.RecordBatch:
        terms, n = [*seen.keys(), None], [*seen.values(), documents]
        return pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.binary()), pa.array(n, pa.int64()), pa.array([0] * len(seen) + [tokens], pa.int64())], ["term", "documents", "tokens"]
        )

    for batch in batches:
        for text in _texts(batch.column(0), 0, batch.num_rows):
            if found := counted(text):
                documents, tokens = documents + 1, tokens + found.total()
                seen.update(found.keys())
                if len(seen) >= COUNTED_TERMS:
                    yield rows(seen, documents, tokens)
                    documents, tokens, seen = 0, 0, Counter()
    yield rows(seen, documents, tokens)


def statistics(texts: DataFrame) -> DataFrame:
    """(term, documents, tokens) over all rows of ``texts`` (one column, text). Written."""
    rows = texts.mapInArrow(_statistics, "term binary, documents long, tokens long")
    return materialize(rows.groupBy("term").agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens")), "terms")


@dataclass
class Treap:
    """A quadtree of a grid of 2**height by 2**height cells; cells of all levels are numbered breadth first from the root, 0."""

    terms: dict[bytes, int]
    height: int
    quarters: np.ndarray  # of each cell four flags: which quarters are not empty
    child: np.ndarray  # their numbers
    largest: np.ndarray  # of each cell the largest impact within it

    @classmethod
    def of(cls, terms: dict[bytes, int], row: np.ndarray, column: np.ndarray, impact: np.ndarray, columns: int) -> Treap:
        """Of cells (row, column) with their impacts; each cell once."""
        height = max(1, int(max(len(terms), columns) - 1).bit_length())
        code = spread_bits(row) << np.uint64(1) | spread_bits(column)
        order = np.argsort(code, kind="stable")
        code, value = code[order], impact[order]
        levels = [(code, value)]
        for _ in range(height):
            code = code >> np.uint64(2)
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            code, value = code[first], np.maximum.reduceat(value, first)
            levels.append((code, value))
        levels.reverse()
        inner = sum(len(c) for c, _ in levels[:-1])
        quarters, at = np.zeros(inner * 4, bool), 0
        for (parents, _), (cells, _) in zip(levels, levels[1:], strict=False):
            parent = np.searchsorted(parents, cells >> np.uint64(2)) + at
            quarters[parent * 4 + (cells & np.uint64(3)).astype(np.int64)] = True
            at += len(parents)
        return cls(terms, height, quarters, np.cumsum(quarters, dtype=np.int32), np.concatenate([v for _, v in levels]))


def spread_bits(x: np.ndarray) -> np.ndarray:
    """The bits of 32-bit numbers at even places."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(mask)
    return x


class Best:
    """The best (score, id) of an item so far; ``none`` marks null ids, which come last."""

    def __init__(self, top: int):
        self.top, self.score, self.id, self.none = top, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def worst(self) -> int:
        """A range with a bound below this can't change what is kept."""
        return max(1, int(self.score[-1])) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, ids: np.ndarray, none: np.ndarray) -> None:
        score, ids, none = np.concatenate([self.score, score]), np.concatenate([self.id, ids]), np.concatenate([self.none, none])
        order = np.lexsort((ids, none, -score))[: self.top]
        self.score, self.id, self.none = score[order], ids[order], none[order]


def descend(tree: Treap, ids: np.ndarray, none: np.ndarray, rows: np.ndarray, weights: np.ndarray, best: Best) -> None:
    """Add to ``best`` the documents (columns) of the grid that score highest with the terms in ``rows``."""
    most = max(1, PATHS_A_STEP // (2 * len(rows)))
    bound = np.array([int(weights.sum()) * int(tree.largest[0])])
    depth, column, cells = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros((1, len(rows)), np.int32)
    while len(bound):
        open_ = bound >= best.worst()
        if not open_.all():
            bound, depth, column, cells = bound[open_], depth[open_], column[open_], cells[open_]
            if not len(bound):
                return
        if len(bound) > most:  # the best ranges are opened, the others wait
            at = np.argpartition(-bound, most - 1)
            now, wait = at[:most], at[most:]
        else:
            now, wait = np.arange(len(bound)), np.zeros(0, np.int64)
        side = (rows[None, :] >> (tree.height - 1 - depth[now])[:, None]) & 1
        quarter = cells[now][:, None, :] * 4 + (side * 2)[:, None, :] + np.arange(2)[None, :, None]
        there = (cells[now] >= 0)[:, None, :] & tree.quarters[quarter]
        child = np.where(there, tree.child[quarter], -1)
        value = (np.where(there, tree.largest[child], 0) * weights).sum(axis=2).ravel()
        next_depth, next_column = np.repeat(depth[now] + 1, 2), (column[now, None] * 2 + np.arange(2)).ravel()
        child, some = child.reshape(-1, len(rows)), value >= best.worst()
        leaf = some & (next_depth == tree.height)
        if leaf.any():
            best.add(value[leaf], ids[next_column[leaf]], none[next_column[leaf]])
        some &= next_depth < tree.height
        bound, depth = np.concatenate([bound[wait], value[some]]), np.concatenate([depth[wait], next_depth[some]])
        column, cells = np.concatenate([column[wait], next_column[some]]), np.concatenate([cells[wait], child[some]])


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, tokens: int) -> np.ndarray:
    """What ``tf`` occurrences among a document's ``n`` terms are worth, in parts of a million."""
    m = 100 - 50 + 50 * n * documents // tokens
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


def grid(texts: list[bytes], documents: int, tokens: int) -> tuple[Treap | None, np.ndarray]:
    """The treap of some documents, and which of them are its columns (those with a term)."""
    terms: dict[bytes, int] = {}
    row, tf, sizes, kept = [], [], [], []
    for k, text in enumerate(texts):
        if found := counted(text):
            row.append(np.fromiter((terms.setdefault(t, len(terms)) for t in found), np.int64, len(found)))
            tf.append(np.fromiter(found.values(), np.int64, len(found)))
            sizes.append((len(found), found.total()))
            kept.append(k)
    if not kept:
        return None, np.zeros(0, np.int64)
    distinct, n = np.array(sizes).T
    column = np.repeat(np.arange(len(kept)), distinct)
    value = impacts(np.concatenate(tf), n[column], documents, tokens)
    return Treap.of(terms, np.concatenate(row), column, value, len(kept)), np.array(kept)


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """For each item of ``items`` (item_id, text) the ``top`` best of ``docs`` (doc_id, text): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = statistics(rows.select("text"))
    documents, tokens = known.filter("term is null").select("documents", "tokens").first() or (0, 0)
    schema = "q long, doc_id long, score long"
    asked = items.select(F.col("item_id").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    asked = materialize(asked.withColumn("q", F.monotonically_increasing_id()), "items")
    found = []
    for queries in weighted_items(asked, known, documents):
        found.append(rows.mapInArrow(searcher(queries, documents, tokens, top), schema))
    best = spark.createDataFrame([], schema) if not found else found[0]
    for more in found[1:]:
        best = best.unionByName(more)
    # the best of each task, then of some tasks, then of all
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = best.withColumn("part", F.spark_partition_id() % GROUPS)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("q", "part").orderBy(*order))).filter(F.col("rank") <= top)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(asked.select("q", "item_id"), "q").select("item_id", "rank", "doc_id", "score")


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for q, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1), 0, batch.num_rows), strict=True):
            if found := list(counted(text)):
                yield pa.RecordBatch.from_arrays([pa.array([q] * len(found), pa.int64()), pa.array(found, pa.binary())], ["q", "term"])


def weighted_items(asked: DataFrame, known: DataFrame, documents: int) -> Iterator[list[tuple[int, list[bytes], list[int]]]]:
    """Bounded parts of the query set: (q, terms, weights) of each item."""
    terms = asked.select("q", "text").mapInArrow(_item_terms, "q long, term binary").join(known, "term").select("q", "term", "documents")
    lists = materialize(terms.groupBy("q").agg(F.collect_list(F.struct("term", "documents")).alias("terms")), "item-terms")
    part, held = [], 0
    for q, some in lists.toLocalIterator():
        if part and (len(part) >= ITEMS_AT_ONCE or held + len(some) > TERMS_AT_ONCE):
            yield part
            part, held = [], 0
        part.append((q, [bytes(t.term) for t in some], [weight(t.documents, documents) for t in some]))
        held += len(some)
    if part:
        yield part


def searcher(queries: list[tuple[int, list[bytes], list[int]]], documents: int, tokens: int, top: int):
    """What a task does with its documents: a grid for each block, every item in each grid."""
    packed = [(q, terms, np.array(w, np.int64)) for q, terms, w in queries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in packed]
        ids: list[pa.Array] = []
        texts: list[bytes] = []
        held = 0

        def answer() -> None:
            """Every item in the grid of the texts held."""
            tree, kept = grid(texts, documents, tokens)
            if tree is None:
                return
            doc_id = pa.concat_arrays(ids).take(pa.array(kept))
            none = doc_id.is_null().to_numpy(zero_copy_only=False)
            doc_id = doc_id.fill_null(0).to_numpy()
            for (_, terms, weights), b in zip(packed, best, strict=True):
                row = np.array([tree.terms.get(t, -1) for t in terms])
                if (row >= 0).any():
                    descend(tree, doc_id, none, row[row >= 0], weights[row >= 0], b)

        for batch in batches:
            for i, j in row_blocks(utf8(batch.column(1))[1], GRID_BYTES):
                part = list(_texts(batch.column(1), i, j))
                size = sum(map(len, part))
                if texts and held + size > GRID_BYTES:
                    answer()
                    ids.clear()
                    texts.clear()
                    held = 0
                ids.append(batch.column(0).slice(i, j - i))
                texts += part
                held += size
        if texts:
            answer()
        for k in range(0, len(packed), 256):
            some = [(q, b) for (q, _, _), b in zip(packed[k : k + 256], best[k : k + 256], strict=True) if len(b.score)]
            if some:
                q = np.repeat([q for q, _ in some], [len(b.score) for _, b in some])
                doc_id, none, score = (np.concatenate([getattr(b, x) for _, b in some]) for x in ("id", "none", "score"))
                columns = [pa.array(q, pa.int64()), pa.array(doc_id, mask=none), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["q", "doc_id", "score"])

    return run
