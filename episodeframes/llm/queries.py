"""The operators of this subpackage as registered queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .arc_warc import archives_query
from .byte_bpe import round_trip
from .chat_views import ORACLE as OP3_SQL
from .chat_views import views_query
from .common import read_table
from .decontamination import find_contaminated
from .embedding_dedup import near_vectors
from .exact_dedup import exact_groups
from .language_id import identify
from .lexical_search import search
from .minhash_dedup import near_duplicates
from .sharding import shards_query
from .suffix_dedup import cut_repeats
from .token_files import token_files_query
from .whitening import whitened


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files_query(spark, read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read_table(spark, sf_dir, "documents"))


def op3_chat_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views_query(spark, sf_dir)


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards_query(spark, read_table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(read_table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(read_table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives_query(spark, read_table(spark, sf_dir, "pages"))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


OP6_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


OP10_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 75 * (x.n + y.n - n_both)),
r AS (SELECT a AS doc_id, a AS c FROM l UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(min(r.c), w.doc_id) AS component_id, coalesce(min(r.c), w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY w.doc_id, n.n
"""


OP11_SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS x,
         coalesce(len(embedding) > 0 AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0
                  AND list_max([abs(c) FOR c IN embedding]) > 0, false) AS good
  FROM embeddings),
u AS (SELECT r, vec_id, x, sqrt(list_sum([c * c FOR c IN x])) AS norm FROM v WHERE good),
l AS (
  SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.r <> b.r AND len(a.x) = len(b.x)
  WHERE list_inner_product(a.x, b.x) >= 0.9 * a.norm * b.norm),
c AS (SELECT a AS r, a AS c FROM l UNION SELECT l.b, c.c FROM c JOIN l ON l.a = c.r),
m AS (SELECT c.r, min(v.vec_id) AS component_id FROM c JOIN v ON v.r = c.c GROUP BY c.r),
n AS (SELECT a AS r, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM v LEFT JOIN m USING (r) LEFT JOIN n USING (r)
"""


OP13_SQL = """
WITH t AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM documents),
f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM f GROUP BY doc_id),
g AS (SELECT count(*) AS nn, sum(n)::BIGINT AS l FROM n),
w AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, g GROUP BY term),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark),
s AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * nn) // l)))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN f USING (term) JOIN n USING (doc_id), g GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": op1_token_files,
        "op2_language_id": op2_language_id,
        "op3_chat_views": op3_chat_views,
        "op4_shards": op4_shards,
        "op5_decontamination": op5_decontamination,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_arc_to_warc": op9_arc_to_warc,
        "op10_minhash_dedup": op10_minhash_dedup,
        "op11_embedding_dedup": op11_embedding_dedup,
        "op12_whitening": op12_whitening,
        "op13_lexical_search": op13_lexical_search,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_chat_views": OP3_SQL, "op6_exact_dedup": OP6_SQL, "op10_minhash_dedup": OP10_SQL, "op11_embedding_dedup": OP11_SQL, "op13_lexical_search": OP13_SQL}
