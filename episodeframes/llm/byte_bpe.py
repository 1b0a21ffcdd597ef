"""Byte-level BPE: recursive queries of an embedded SQL engine inside each Spark partition.

Texts are split by the tokenizer's pattern. The distinct words that a worker has not met yet become rows (word,
position, token) of a seed table, one row a byte. A recursive query joins each pair of neighbours with the merge table
and contracts the leftmost pair of the lowest rank of every word, until no word has a pair that merges; an ordered
aggregation yields the ids, and another decodes ids to bytes. The merge table has every way to cut a token in two
tokens, so that a pair merges exactly when its joined bytes are a token.

Pairs that need not wait contract in the same step. Let a and b be neighbours whose joined bytes have rank k, p the byte
before them and n the byte after. Anything else that takes a first makes a token that ends with p and a; with b, one
that begins with b and n; and what ab merges into ends with p and ab, or begins with ab and n. If no token of rank k or
below does so, the plain rule contracts a and b before it touches either, and ab takes no part in a merge before rank k,
so contracting them at once changes nothing. p and n are bytes of the word, which stay as they are; the merge table has
for each pair those bytes before and after it with which it has to wait.

Words of over LONG bytes contract all
occurrences of their lowest pair in one step where that cannot change the outcome: when no pair with the new token has
a lower rank, the next step of the plain rule would take the next occurrence anyway. Such words are first cut between
bytes that no token has side by side, which no merge can cross, and their steps are taken in rounds of bounded size.

Recent words are kept (two generations of MOST_BYTES each, so what recurs stays) as their ids and as the bytes to which the
ordered aggregation decodes these ids; what a document decodes to is made of those bytes alone, never of the text.

Defined results: a null or empty text has no tokens; repeated rows are each encoded; other columns are ignored. Texts
are taken in blocks and long ones in parts, so memory doesn't grow with the corpus or a document.
"""

from __future__ import annotations

import base64
import contextlib
import hashlib
import itertools
import re
import unicodedata
from array import array
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, row_blocks, utf8

LONG = 256
#: Characters from which on a text is taken in parts of WORDS_AT_ONCE words.
WHOLE = 1 << 20
WORDS_AT_ONCE = 100_000
MOST_BYTES = 40 << 20
WORDS_A_QUERY, BYTES_A_QUERY = 10_000, 1 << 20
#: Rows of all steps of one round over long words.
ROWS_A_ROUND = 4_000_000
#: Ids that one query decodes; a longer list is decoded by several.
IDS_A_QUERY = 200_000
MEMORY, MEMORY_AT_REST = "1GB", "50MB"
#: The pattern of the rank files in use; for it, texts in Latin-1 are split by explicit classes (the same words, faster).
KNOWN_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: A pair's number holds its rank and its place; from NONE on it has no rank, below 0 it need not wait (NONE is taken off).
NONE = 1 << 62
NUMBER = f"CASE WHEN (m.before & pb) | (m.after & nb) = 0 THEN (m.k << 32) + p - {NONE} ELSE coalesce(m.k << 32, {NONE}) + p END"
#: Rows are (word, place, next place, token, next token, bits of the bytes around the pair, number of the pair). In each
#: step the pairs that need not wait contract, or, where a word has none, its leftmost pair of lowest rank.
ENCODE = f"""
WITH RECURSIVE step AS (
  SELECT w, p, np, t, nt, pb, nb, {NUMBER} AS k, false AS fin FROM seed LEFT JOIN m ON m.lr = t::BIGINT * 65536 + nt
  UNION ALL
  (WITH met AS MATERIALIZED (
     SELECT s.w, s.p, s.np, s.t, s.nt, s.pb, s.nb, s.k, b.k >= {NONE} AS fin, s.k < 0 OR (s.k = b.k AND b.k < {NONE}) AS hit
     FROM step s JOIN (SELECT w, min(k) AS k FROM step WHERE NOT fin GROUP BY w) b ON s.w = b.w),
   hits AS MATERIALIZED (SELECT p, np, ((k + {NONE}) >> 32 & {(1 << 30) - 1})::INT AS t, pb, nb FROM met WHERE hit),
   moved AS (
     SELECT x.w, coalesce(a.p, x.p) AS p, x.np, coalesce(a.t, x.t) AS t, coalesce(c.t, x.nt) AS nt, coalesce(a.pb, x.pb) AS pb,
            coalesce(c.nb, x.nb) AS nb, CASE WHEN a.p IS NULL AND c.p IS NULL THEN x.k END AS same, x.fin
     FROM met x LEFT JOIN hits a ON x.p = a.np LEFT JOIN hits c ON x.np = c.p WHERE NOT x.hit)
   SELECT w, p, np, t, nt, pb, nb, coalesce(same, {NUMBER}), fin
   FROM moved LEFT JOIN m ON m.lr = CASE WHEN same IS NULL THEN t::BIGINT * 65536 + nt END))
SELECT w, t FROM step WHERE fin ORDER BY p
"""
#: For each pair that merges, the bits of bytes before (after) it with which it has to wait its turn: those that some token
#: of no higher rank has before the pair or its first token (after the pair or its second).
WAITS = """
CREATE TABLE {side} AS
WITH near AS (SELECT {near} AS id, {bit} AS bit, min(k) AS k FROM given WHERE {near} >= 0 GROUP BY ALL)
SELECT lr, bit_or(bit) AS bits
FROM (SELECT lr, bit FROM merges JOIN near ON id = merges.{own} AND near.k <= merges.k
      UNION ALL SELECT lr, bit FROM merges JOIN near ON id = merges.k AND near.k <= merges.k) GROUP BY lr
"""
ENCODE_LONG = """
WITH RECURSIVE step AS (
  SELECT w, p, t, false AS fin, 0 AS d FROM seed
  UNION ALL
  SELECT w, p, CASE WHEN hit THEN best ELSE t END AS t, best IS NULL AS fin, d + 1 FROM (
    SELECT *, lag(hit, 1, false) OVER (PARTITION BY w ORDER BY p) AS eaten FROM (
      SELECT w, p, t, d, best, coalesce(fits AND CASE WHEN safe THEN (n - run) % 2 = 0 ELSE p = f END, false) AS hit FROM (
        SELECT *, max(CASE WHEN fits AND NOT before THEN n END) OVER (PARTITION BY w ORDER BY p) AS run,
               min(p) FILTER (fits) OVER (PARTITION BY w) AS f FROM (
          SELECT *, lag(fits, 1, false) OVER (PARTITION BY w ORDER BY p) AS before FROM (
            SELECT *, coalesce(k = best, false) AS fits FROM (
              SELECT a.*, m.k, m.safe, min(m.k) OVER (PARTITION BY a.w) AS best FROM (
                SELECT w, p, t, d, lead(t) OVER (PARTITION BY w ORDER BY p) AS nt,
                       row_number() OVER (PARTITION BY w ORDER BY p) AS n
                FROM step WHERE NOT fin AND d < {steps}) a
              LEFT JOIN m ON m.l = a.t AND m.r = a.nt))))))
  WHERE NOT eaten)
SELECT w, p, t, fin FROM step WHERE fin OR d = {steps} ORDER BY w, p
"""
DECODE = "SELECT d, unhex(string_agg(hex, '' ORDER BY p)) AS bytes FROM ids JOIN v USING (id) GROUP BY d ORDER BY d"


def latin_pattern() -> re.Pattern:
    def chars(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(256) if unicodedata.category(chr(c))[0] == kind)

    letter, digit, space = chars("L"), chars("N"), r"\t\n\x0b\x0c\r \x85\xa0"
    return re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{letter}]+| ?[{digit}]+| ?[^{space}{letter}{digit}]+|[{space}]+(?![^{space}])|[{space}]+")


class Coder:
    """Ranks, merge table and known words of one worker process."""

    def __init__(self, ranks_path: str, pattern: str):
        import duckdb
        import regex

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        raw = np.frombuffer(b"".join(ranks), np.uint8)
        self.bit = np.full(256, 1 << 63, np.uint64)  # the last is shared by all but the 63 most frequent bytes
        self.bit[np.argsort(-np.bincount(raw, minlength=256), kind="stable")[:63]] = np.uint64(1) << np.arange(63, dtype=np.uint64)
        places = ((t, k, i) for t, k in ranks.items() for i in range(1, len(t)))
        cuts = np.array([(ranks.get(t[:i], -1), ranks.get(t[i:], -1), k, t[i - 1], t[i]) for t, k, i in places], np.int64)
        merges = cuts[(cuts[:, :2] >= 0).all(1), :3]
        lower = np.concatenate([merges[merges[:, i] > merges[:, 2], i] for i in (0, 1)])
        safe = ~np.isin(merges[:, 2], lower)
        m = {"l": merges[:, 0], "r": merges[:, 1], "lr": merges[:, 0] << 16 | merges[:, 1], "k": merges[:, 2], "safe": safe}
        v = {"id": np.array(list(ranks.values()), np.int64), "hex": [b.hex() for b in ranks]}
        c = {"l": cuts[:, 0], "r": cuts[:, 1], "k": cuts[:, 2], "pb": self.bit[cuts[:, 3]], "nb": self.bit[cuts[:, 4]]}
        self.sql = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY})
        self.sql.execute("SET temp_directory = ''")
        for name, table in (("merges", m), ("v", v), ("given", c)):
            self.sql.register("table_given", pa.table(table))
            self.sql.execute(f"CREATE TABLE {name} AS SELECT * FROM table_given")
            self.sql.unregister("table_given")
        self.sql.execute(WAITS.format(side="before", near="r", own="l", bit="pb"))
        self.sql.execute(WAITS.format(side="after", near="l", own="r", bit="nb"))
        self.sql.execute(
            "CREATE TABLE m AS SELECT merges.*, coalesce(before.bits, 0)::UBIGINT AS before, coalesce(after.bits, 0)::UBIGINT AS after "
            "FROM merges LEFT JOIN before USING (lr) LEFT JOIN after USING (lr)"
        )
        for name in ("given", "merges", "before", "after"):
            self.sql.execute(f"DROP TABLE {name}")
        self.flush()
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.side_by_side = np.zeros((256, 256), bool)
        for x in ranks:
            self.side_by_side[list(x[:-1]), list(x[1:])] = True
        self.pattern = regex.compile(pattern)
        self.latin = latin_pattern() if pattern == KNOWN_PATTERN else None
        self.wide = re.compile(r"[^\x00-\xff]")
        # ids and bytes of recent words, a line's end between them: one object takes up half of what a tuple of two does
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def rest(self) -> None:
        """Between tasks a worker keeps its known words, and the engine no more than its tables."""
        self.sql.execute(f"SET memory_limit = '{MEMORY_AT_REST}'")
        pa.default_memory_pool().release_unused()

    def flush(self) -> None:
        """What queries have used goes back to the system: the engine gives up freed pages when its limit is set, not before."""
        self.rest()
        self.sql.execute(f"SET memory_limit = '{MEMORY}'")

    @contextlib.contextmanager
    def awake(self) -> Iterator[None]:
        """The engine has all its memory while a task uses it, and gives it back however the task ends."""
        self.sql.execute(f"SET memory_limit = '{MEMORY}'")
        try:
            yield
        finally:
            self.rest()

    def split(self, text: str) -> Iterator[list[str]]:
        """The words of a text, at most WORDS_AT_ONCE in a list."""
        pattern = self.pattern if self.latin is None or self.wide.search(text) else self.latin
        if len(text) < WHOLE:
            yield pattern.findall(text)
            return
        found = (x.group() for x in pattern.finditer(text))
        while part := list(itertools.islice(found, WORDS_AT_ONCE)):
            yield part

    def known(self, words: Iterable[str]) -> list[tuple[bytes, bytes]]:
        """Of each of these distinct words the decimal ids, joined by blanks, and the bytes that these ids decode to.

        What was not used for MOST_BYTES of words is forgotten.
        """
        if self.held > MOST_BYTES:
            self.recent, self.older, self.held = {}, self.recent, 0
        missing = set(words).difference(self.recent)
        found = {x: self.older[x] for x in missing if x in self.older}
        missing.difference_update(found)
        long = [x for x in missing if len(x) * 4 > LONG and len(x.encode()) > LONG]
        for some, code in ((list(missing.difference(long)), self.coded), (long, self.coded_long)):
            i = 0
            while i < len(some):  # many words a query, but a bounded number of bytes
                j = size = 0
                while i + j < len(some) and j < WORDS_A_QUERY and size < BYTES_A_QUERY:
                    size += len(some[i + j])
                    j += 1
                ids = code([x.encode() for x in some[i : i + j]])
                found.update(zip(some[i : i + j], map(b"%b\n%b".__mod__, zip(ids, self.decoded(ids), strict=True)), strict=True))
                i += j
        if missing:
            self.flush()
        self.recent.update(found)
        self.held += held_bytes(found)
        return [tuple(self.recent[x].split(b"\n", 1)) for x in words]

    def seed(self, words: list[bytes]) -> pa.Table:
        w, p, t, last = self.rows(words)
        bit, none, at = self.bit[np.frombuffer(b"".join(words), np.uint8)], np.uint64(0), np.arange(len(p), dtype=np.int32)
        after = np.where(last, none, np.roll(bit, -1))
        return pa.table({
            "w": w.astype(np.int32), "p": at, "np": np.where(last, np.int32(-1), at + np.int32(1)), "t": t.astype(np.int32),
            "nt": pa.array(np.roll(t, -1).astype(np.int32), mask=last),
            "pb": np.where(p == 0, none, np.roll(bit, 1)), "nb": np.where(last, none, np.roll(after, -1)),
        })

    def coded(self, words: list[bytes]) -> list[bytes]:
        self.sql.register("seed", self.seed(words))
        found = self.sql.execute(ENCODE).fetchnumpy()
        self.sql.unregister("seed")
        return joined(found["w"], found["t"], len(words))

    def coded_long(self, words: list[bytes]) -> list[bytes]:
        w, p, t, last = self.rows(words)
        raw = np.frombuffer(b"".join(words), np.uint8)
        apart = np.append(True, ~self.side_by_side[raw[:-1], raw[1:]] | last[:-1])
        owner, w = w[apart], np.cumsum(apart) - 1  # w is now the number of a piece, owner the word of each piece
        done, n = [], len(raw)
        while n:
            self.sql.register("seed", pa.table({"w": w, "p": p, "t": t}))
            found = self.sql.execute(ENCODE_LONG.format(steps=max(1, ROWS_A_ROUND // n))).fetchnumpy()
            self.sql.unregister("seed")
            fin = found["fin"]
            done.append((found["w"][fin], found["p"][fin], found["t"][fin]))
            w, p, t = (found[c][~fin] for c in ("w", "p", "t"))
            n = len(w)
        w, p, t = (np.concatenate(c) for c in zip(*done, strict=True))
        order = np.lexsort((p, w))
        return joined(owner[w[order]], t[order], len(words))

    def rows(self, words: list[bytes]) -> tuple[np.ndarray, ...]:
        """Word, place, token, and whether it is the word's last, for each byte."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        flat, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes)
        last = np.zeros(len(flat), bool)
        last[ends - 1] = True
        return np.repeat(np.arange(len(words)), sizes), np.arange(len(flat)) - np.repeat(ends - sizes, sizes), self.byte[flat], last

    def documents(self, texts: list[str | None]) -> Iterator[Iterator[list[tuple[bytes, bytes]]]]:
        """For each text its words' ids and bytes, in lists; to be taken in order."""
        for long, some in itertools.groupby(texts, lambda x: x is not None and len(x) >= WHOLE):
            if long:
                yield from (map(self.looked_up, self.split(x)) for x in some)
            else:
                # places in the list of the block's words: the words themselves, one by one, take up 15 times their text
                place = defaultdict(itertools.count().__next__)
                placed = [array("i", map(place.__getitem__, next(self.split(x)) if x else [])) for x in some]
                get = self.known(place).__getitem__
                yield from (iter([list(map(get, at))]) for at in placed)

    def looked_up(self, words: list[str]) -> list[tuple[bytes, bytes]]:
        distinct = dict.fromkeys(words)
        return list(map(dict(zip(distinct, self.known(distinct), strict=True)).__getitem__, words))

    def decoded(self, ids: list[bytes]) -> list[bytes]:
        """The bytes that each sequence of decimal ids stands for."""
        sizes = np.fromiter((x.count(b" ") + 1 for x in ids), np.int64, len(ids))
        flat = np.array(b" ".join(ids).split(), np.int32)
        found = self.decode(pa.table({"d": np.repeat(np.arange(len(ids)), sizes), "p": np.arange(len(flat)), "id": flat}))
        return [found[d] for d in range(len(ids))]

    def decode(self, rows: pa.Table) -> dict[int, bytes]:
        """Bytes by d, from rows (d, p, id) with the ids of a sequence d in the order of p."""
        self.sql.register("ids", rows)
        found = dict(self.sql.execute(DECODE).fetchall())
        self.sql.unregister("ids")
        return found


def held_bytes(words: dict[str, bytes]) -> int:
    """About what known words take up: two objects and a place in a dictionary, the word twice and its ids."""
    return 150 * len(words) + sum(map(len, words)) + sum(map(len, words.values()))


def joined(w: np.ndarray, t: np.ndarray, words: int) -> list[bytes]:
    """Decimal ids of each word, from tokens sorted by word."""
    cut, ids = np.searchsorted(w, np.arange(words + 1)).tolist(), [b"%d" % x for x in t.tolist()]
    return [b" ".join(ids[i:j]) for i, j in itertools.pairwise(cut)]


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(ranks_path: str, pattern: str) -> Coder:
    if (ranks_path, pattern) not in _CODERS:
        _CODERS[ranks_path, pattern] = Coder(ranks_path, pattern)
    return _CODERS[ranks_path, pattern]


def _blocks(batch: pa.RecordBatch, text: int) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    for i, j in row_blocks(utf8(batch.column(text))[1], 4 << 20):
        part = batch.slice(i, j - i)
        yield part, part.column(text).to_pylist()


def encode(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(ranks_path, pattern)
        with code.awake():
            for batch in batches:
                for part, texts in _blocks(batch, 1):
                    ids = []
                    for doc in code.documents(texts):
                        parts = [np.array(b" ".join([w[0] for w in words]).split(), np.int32) for words in doc]
                        ids.append(np.concatenate([np.zeros(0, np.int32), *parts]))
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and the bytes that the ids stand for (null ids, and nulls among them: no bytes); an id without a rank is an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(ranks_path, pattern)
        with code.awake():
            known = code.sql.execute("SELECT max(id) FROM v").fetchall()[0][0]
            for batch in batches:
                lists = batch.column(1)
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                for i, j in row_blocks(np.append(0, np.cumsum(sizes)), IDS_A_QUERY):
                    some = lists.slice(i, j - i)
                    owner, flat = np.repeat(np.arange(j - i), sizes[i:j]), some.flatten()
                    there = flat.is_valid().to_numpy(zero_copy_only=False)
                    owner, flat = owner[there], flat.drop_null().to_numpy()
                    if len(flat) and not 0 <= flat.min() <= flat.max() <= known:
                        raise ValueError("an id that the ranks don't have")
                    out = [[] for _ in range(j - i)]
                    for k in range(0, len(flat), IDS_A_QUERY):  # a longer list in several queries
                        d, ids = owner[k : k + IDS_A_QUERY], flat[k : k + IDS_A_QUERY]
                        for at, raw in code.decode(pa.table({"d": d, "p": np.arange(len(ids)), "id": ids})).items():
                            out[at].append(raw)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(map(b"".join, out), pa.binary())], ["doc_id", "bytes"])

    bounded_batches(coded.sparkSession)
    rows = coded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text in one pass: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The ids of each word come from the recursive query and are decoded by the ordered aggregation over those ids alone;
    a document's ids and bytes are those of its words in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(ranks_path, pattern)
        with code.awake():
            for batch in batches:
                for part, texts in _blocks(batch, 1):
                    rows = []
                    for doc in code.documents(texts):
                        n, ids, raw, between = 0, hashlib.sha256(), hashlib.sha256(), b""
                        for words in doc:
                            if words:
                                decimal = b" ".join([w[0] for w in words])
                                n += decimal.count(b" ") + 1
                                ids.update(between + decimal)
                                raw.update(b"".join([w[1] for w in words]))
                                between = b" "
                        rows.append((n, ids.hexdigest(), raw.hexdigest()))
                    n, ids, raw = zip(*rows, strict=True)
                    columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids), pa.array(raw)]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
