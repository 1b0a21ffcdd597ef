"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection.

A text's features are the character n-grams of its lower-cased words, with a mark at the words' ends, hashed to BUCKETS
rows of an embedding. The model is ``softmax(mean(E[features]) @ W + b)``, trained by stochastic gradient descent in numpy
on a bounded sample of labelled rows (at most about ``per_language`` of each of the MOST_LANGUAGES most frequent labels).
Part of that sample is kept from the fit, and a temperature is fitted on it. A softmax is sure of anything it has never
seen, so what is rejected is a text whose n-grams are too rarely among those that occur in SEEN sample texts of the
predicted language. The threshold is the share below which only ALPHA of the sample's rows lie, each held against all
others (PRIOR known n-grams are added, so that short texts don't fall by chance). Prediction is a pass over the corpus
without a shuffle: mean and product commute, so a task needs only ``E @ W`` and what n-grams each language has.

Defined results: a text that is null or has no letter is ``und`` with score 0 and rejected; whole texts count; repeated
rows are each predicted; without labelled rows everything is ``und``; below 50 labelled rows only texts without a letter
are rejected. Texts of over PIECE characters are taken in pieces that end between words, which doesn't change their sums. Language, source and id are never inputs of a
prediction. Other columns are ignored (or carried, by ``keep_identified``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, held_out, positional, row_blocks, utf8

BUCKETS = 1 << 15
ORDERS = (2, 3, 4)
DIM = 16
EPOCHS = 4
RATE = 0.2
ALPHA = 0.001
SEEN, PRIOR = 2, 20
PER_LANGUAGE = 800
#: Labels beyond the most frequent ones are not learned.
MOST_LANGUAGES = 500
#: Bounds of the sample that the driver fits on: characters of a text (of longer ones a part), and of all texts.
MOST_SAMPLE_CHARS, SAMPLE_CHARS = 1 << 14, 64 << 20
PIECE = 1 << 19
UNKNOWN = "und"
MARK = 32

_LETTERS = None


def letters() -> np.ndarray:
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def marked_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the letters of all texts, words apart by one MARK and each text between marks; the n + 1 bounds."""
    lower = [(t or "").lower() for t in texts]
    codes = np.frombuffer((" " + " ".join(lower) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, lower), np.int64, len(lower)) + 1)])
    letter = letters()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[bounds[:-1]] = True  # the mark before each text, so that no n-gram reaches from one text into the next
    kept = np.where(letter, codes, np.uint32(MARK))[keep]
    return kept, np.concatenate([[0], np.cumsum(keep)])[bounds]


def features(codes: np.ndarray) -> Iterator[np.ndarray]:
    """For each order the bucket of the n-gram that begins at each place; BUCKETS where a mark lies inside it."""
    mark = codes == MARK
    for n in ORDERS:
        m = len(codes) - n + 1
        if m < 1:
            continue
        h = np.full(m, 2166136261 + n, np.uint32)
        for k in range(n):
            h = (h ^ codes[k : k + m]) * np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        bucket = (h >> np.uint32(17)).astype(np.int32) if BUCKETS == 1 << 15 else (h % BUCKETS).astype(np.int32)
        inside = np.zeros(m, bool)
        for k in range(1, n - 1):
            inside |= mark[k : k + m]
        if n == 2:
            inside = mark[:m] & mark[1 : m + 1]
        bucket[inside] = BUCKETS
        yield bucket


def bags(texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Distinct buckets of each text, their shares, and the number of n-grams."""
    out = []
    for t in texts:
        codes, _ = marked_words([t])
        found = np.bincount(np.concatenate([np.zeros(0, np.int32), *features(codes)]), minlength=BUCKETS + 1)[:BUCKETS]
        at = np.flatnonzero(found)
        out.append((at, (found[at] / max(1, found[at].sum())).astype(np.float32), int(found.sum())))
    return out


def pieces(texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The texts, long ones cut between words, and the number of the text that each piece belongs to."""
    out, owner = [], []
    for n, text in enumerate(texts):
        text = text or ""
        at = 0
        while len(text) - at > PIECE:
            end = at + PIECE
            while end < len(text) and (text[end].isalpha() or text[end - 1].isalpha()):
                end += 1
            out.append(text[at:end])
            owner.append(n)
            at = end
        out.append(text[at:])
        owner.append(n)
    return out, np.array(owner, np.int64)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # (languages, BUCKETS + 1); the last column is zero
    bias: np.ndarray
    seen: np.ndarray  # (languages, BUCKETS + 1): whether a language's training texts have the n-gram
    temperature: float = 1.0
    threshold: float = 0.0

    def sums(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sums of each text's features over the table, over what each language has seen, and the number of features."""
        codes, bounds = marked_words(texts)
        k = len(self.languages)
        total, known, n = np.zeros((len(texts), k)), np.zeros((len(texts), k)), np.zeros(len(texts))
        has = np.diff(np.concatenate([[0], np.cumsum(codes != MARK)])[bounds]) > 0
        for bucket in features(codes):
            # an n-gram belongs to the text in which it begins; one that reaches into the next has a mark inside
            at = np.minimum(bounds[:-1], max(0, len(bucket) - 1))
            n += np.where(has, np.add.reduceat((bucket != BUCKETS).astype(np.int32), at), 0)
            for j in range(k):
                total[:, j] += np.where(has, np.add.reduceat(self.table[j][bucket], at, dtype=np.float64), 0)
                known[:, j] += np.where(has, np.add.reduceat(self.seen[j][bucket], at, dtype=np.int32), 0)
        return total, known, n

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities and known shares (texts x languages), and which texts have a letter."""
        k, parts = len(self.languages), pieces(texts)
        total, known, n = np.zeros((len(texts), k)), np.zeros((len(texts), k)), np.zeros(len(texts))
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(np.fromiter(map(len, parts[0]), np.int64, len(parts[0])))])
        for i, j in row_blocks(ends, PIECE):
            for whole, part in zip((total, known, n), self.sums(parts[0][i:j]), strict=True):
                np.add.at(whole, parts[1][i:j], part)
        some = np.maximum(n, 1)[:, None]
        return self.softmax(total / some + self.bias), (known + PRIOR) / (some + PRIOR), n > 0

    def softmax(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """(language, score, accepted) of each text."""
        if not self.languages:
            return [(UNKNOWN, 0.0, False)] * len(texts)
        p, known, has = self.scores(texts)
        best = p.argmax(axis=1)
        rows = np.arange(len(texts)), best
        found = zip(best.tolist(), p[rows].tolist(), (known[rows] >= self.threshold).tolist(), has.tolist(), strict=True)
        return [(self.languages[k], s, ok) if h else (UNKNOWN, 0.0, False) for k, s, ok, h in found]


def fit(rows: list[tuple[str, str]], seed: int = 0) -> Model:
    """Train and calibrate on (text, language) rows; every fifth row is kept for calibration."""
    languages = sorted({lang for _, lang in rows})
    if not languages:
        return Model([], np.zeros((0, BUCKETS + 1), np.float32), np.zeros(0), np.zeros((0, BUCKETS + 1), np.uint8))
    rng, k = np.random.default_rng(seed), len(languages)
    y, xs = np.array([languages.index(lang) for _, lang in rows]), bags([t for t, _ in rows])
    usable = [i for i, x in enumerate(xs) if len(x[0])]
    train, held = [i for i in usable if i % 5 or len(usable) < 50], [i for i in usable if i % 5 == 0]
    e, w, b = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32), rng.normal(0, 0.3, (DIM, k)).astype(np.float32), np.zeros(k, np.float32)
    for step in range(EPOCHS):
        rate = RATE * (1 - step / EPOCHS)
        for i in rng.permutation(train):
            at, share, _ = xs[i]
            mean = share @ e[at]
            z = mean @ w + b
            g = np.exp(z - z.max())
            g /= g.sum()
            g[y[i]] -= 1
            back = w @ g
            w -= rate * np.outer(mean, g)
            b -= rate * g
            # scaled so that the text's mean takes a plain step, however its shares are spread
            e[at] -= (rate / float(share @ share) * share)[:, None] * back
    if not (np.isfinite(e).all() and np.isfinite(w).all()):
        raise FloatingPointError("the language model did not converge")
    table = np.vstack([e @ w, np.zeros((1, k), np.float32)]).T.copy()
    counts = np.zeros((k, BUCKETS + 1), np.int32)
    for i in usable:
        counts[y[i], xs[i][0]] += 1
    model = Model(languages, table, b.astype(np.float64), (counts >= SEEN).astype(np.uint8))
    if len(train) < len(usable):
        p, _, _ = model.scores([rows[i][0] for i in held])
        own, logits = (np.arange(len(held)), y[held]), np.log(p + 1e-30)  # of temperature 1

        def loss(t: float) -> float:
            model.temperature = t
            return -float(np.log(model.softmax(logits)[own] + 1e-12).mean())

        model.temperature = min(np.geomspace(0.5, 20, 60), key=loss)
        known = [(xs[i][1][counts[y[i], xs[i][0]] > SEEN].sum() * xs[i][2] + PRIOR) / (xs[i][2] + PRIOR) for i in usable]
        model.threshold = float(np.quantile(known, ALPHA))
    return model


def sample(
    docs: DataFrame, per_language: int = PER_LANGUAGE, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
) -> list[tuple[str, str]]:
    """At most ``per_language`` labelled rows of each language outside the held-out share, chosen by a hash.

    Each language has an equal part of SAMPLE_CHARS, so the sample is bounded whatever their number or the texts' lengths.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).filter("doc_id is not null and lang is not null and text is not null")
    rows = rows.filter(~held_out())
    frequent = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    counts = dict(map(tuple, frequent.collect()))
    if not counts:
        return []
    share = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.3 * per_language / n))))[F.col("lang")]
    order = F.xxhash64("doc_id", "text")
    drawn = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20) < share)
    drawn = drawn.select("lang", F.substring("text", 1, MOST_SAMPLE_CHARS).alias("text"), order.alias("order"))
    by = Window.partitionBy("lang").orderBy("order", "text")
    drawn = drawn.withColumn("no", F.row_number().over(by)).filter(F.col("no") <= per_language)
    drawn = drawn.withColumn("chars", F.sum(F.length("text")).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    drawn = drawn.filter(F.col("chars") <= max(MOST_SAMPLE_CHARS, SAMPLE_CHARS // len(counts)))
    return [(r.text, r.lang) for r in drawn.orderBy("order", "text").select("text", "lang").collect()]


def _predict(model, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in row_blocks(utf8(batch.column(text))[1]):
                part = batch.slice(i, j - i)
                lang, score, accepted = zip(*model.value.predict(part.column(text).to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lang), pa.array(score, pa.float64()), pa.array(accepted)],
                    [*part.schema.names, "lang_pred", "score", "accepted"]
                )

    return run


def predicted(rows: DataFrame, text: str, model: Model) -> DataFrame:
    """``rows`` with lang_pred, score and accepted."""
    bounded_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*rows.schema.fields, *T._parse_datatype_string("lang_pred string, score double, accepted boolean").fields])
    return rows.mapInArrow(_predict(shared, rows.columns.index(text)), schema)


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score, accepted for every document."""
    model = fit(sample(docs, per_language))
    return predicted(docs.select("doc_id", "text"), "text", model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "accepted")


def keep_identified(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The documents whose language is not rejected, with their columns unchanged."""
    model = fit(sample(docs, per_language))
    rows, names = positional(docs)
    return predicted(rows, f"_{names.index('text')}", model).filter("accepted").select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(names)))
