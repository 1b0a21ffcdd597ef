"""Perspective rotation of multi-party dialogues.

For every participant of a conversation the dialogue is rendered once more, with that speaker as the assistant, all
others as users under their names, and a mask of the characters that the assistant is to learn (its texts and their end
marks). Turns meet their conversation's participants, a row each, in a join that is salted where a conversation has over
SALT turns, are dealt by ranges of (conversation, speaker) and sorted, and each task renders its run of turns. A conversation of over ``piece_chars`` may be dealt by ranges of its turns
too, to any number of tasks: it comes out in pieces, whose number and first character follow from sums over pieces.

Defined results: turns are in the order of turn (nulls first), then speaker and text; repeated turns are repeated; a null
text is empty and a null role is the speaker ``unknown``; roles in ``system`` take no perspective and keep their name;
a conversation without participants gives no rows; null conv_ids are one conversation. ``<|`` within a text becomes
``< |``, so no text can forge a mark. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, join_groups, materialize, partitions_for, read_table

PIECE_CHARS = 1 << 20
SALT = 1024
END = "<|end|>\n"
SCHEMA = "conv_id long, speaker string, part int, no long, n_turns long, chars long, text string, mask array<struct<start:long,end:long>>"
MASK = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def head(role: str, speaker: str, system: tuple[str, ...]) -> str:
    if role == speaker:
        return "<|assistant|>\n"
    return f"<|{role}|>\n" if role in system else f"<|user name={role}|>\n"


def _render(system: tuple[str, ...], piece_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, no, key, done, held = TaskContext.get().partitionId(), 0, None, [], 0
        texts, mask, chars = [], [], 0

        def piece():
            return (*key, part, no, len(texts), chars, "".join(texts), mask)

        for batch in batches:
            for conv, speaker, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if texts and ((conv, speaker) != key or chars >= piece_chars):
                    done.append(piece())
                    held, no = held + chars, no + 1
                    texts, mask, chars = [], [], 0
                    if held > 4 << 20:
                        yield _pieces(done)
                        done, held = [], 0
                key = (conv, speaker)
                start, body = head(role, speaker, system), text.replace("<|", "< |")
                if role == speaker:
                    mask.append({"start": chars + len(start), "end": chars + len(start) + len(body) + len(END)})
                texts.append(start + body + END)
                chars += len(texts[-1])
        if texts:
            done.append(piece())
        if done:
            yield _pieces(done)

    return run


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), MASK)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        ["conv_id", "speaker", "part", "no", "n_turns", "chars", "text", "mask"]
    )


def rotate(
    turns: DataFrame, system: tuple[str, ...] = ("system",), piece_chars: int = PIECE_CHARS, conv_id: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text"
) -> DataFrame:
    """conv_id, speaker, piece, start (first character in the whole), n_turns, text, mask (relative to the piece)."""
    spark = turns.sparkSession
    bounded_batches(spark)
    rows = turns.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("unknown")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    speaks = ~F.col("role").isin(*system) if system else F.lit(True)
    rows = rows.withColumn("none", F.col("conv_id").isNull()).withColumn("conv_id", F.coalesce("conv_id", F.lit(0).cast("long")))
    conv = ["none", "conv_id"]
    sizes = rows.groupBy(*conv).agg(F.sum(F.length("text") + 64).alias("size"), F.count(F.lit(1)).alias("n"))
    sizes = materialize(sizes.withColumn("salts", F.ceil(F.col("n") / SALT).cast("int")), "chat-sizes")
    speakers = join_groups(rows.filter(speaks).select(*conv, F.col("role").alias("speaker")).distinct(), sizes, conv, "n")
    speakers = speakers.select(*conv, "speaker", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    turned = join_groups(rows, sizes, conv, "n").withColumn("salt", F.pmod(F.xxhash64("turn", "role", "text"), F.col("salts")).cast("int"))
    met = turned.join(speakers, [*conv, "salt"])
    seen = met.select(
        F.when(~F.col("none"), F.col("conv_id")).alias("conv_id"), "speaker", "role", "text", "turn", (F.col("size") > piece_chars).alias("large")
    )
    cut = [F.when(F.col("large"), F.col(c)) for c in ("turn", "role")]
    dealt = seen.repartitionByRange(
        partitions_for(spark), "conv_id", "speaker", *cut
    ).sortWithinPartitions("conv_id", "speaker", "turn", "role", "text")
    pieces = materialize(dealt.select("conv_id", "speaker", "role", "text").mapInArrow(_render(system, piece_chars), SCHEMA), "chat-pieces")
    order = Window.partitionBy("conv_id", "speaker").orderBy("part", "no")
    before = F.coalesce(F.sum("chars").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # the sums run over a row for each piece, without its text
    places = pieces.select(
        "conv_id", "speaker", "part", "no", (F.row_number().over(order) - 1).alias("piece"), before.alias("start")
    ).select("part", "no", "piece", "start")
    return pieces.join(places, ["part", "no"]).select("conv_id", "speaker", "piece", "start", "n_turns", "text", "mask")


def views_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views with their masks as text (``start-end`` joined by commas)."""
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    return rotate(read_table(spark, sf_dir, "conversations")).withColumn("mask", F.array_join(spans, ","))


ORACLE = """
WITH c AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM c WHERE role <> 'system'),
r AS (
  SELECT c.conv_id, speaker, turn, role, text,
         CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>' ELSE '<|user name=' || role || '|>' END || chr(10) AS head,
         text || '<|end|>' || chr(10) AS body
  FROM c JOIN s ON c.conv_id IS NOT DISTINCT FROM s.conv_id),
p AS (
  SELECT *, coalesce(sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker ORDER BY turn NULLS FIRST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS place FROM r)
SELECT conv_id, speaker, 0 AS piece, 0::BIGINT AS start, count(*) AS n_turns,
       string_agg(head || body, '' ORDER BY turn NULLS FIRST, role, text) AS text,
       coalesce(string_agg(CASE WHEN role = speaker THEN place || '-' || (place + length(body)) END, ',' ORDER BY place), '') AS mask
FROM p GROUP BY conv_id, speaker
"""
