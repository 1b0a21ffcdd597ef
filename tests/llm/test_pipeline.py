import hashlib

import corpus_pipeline

from .test_decontamination import brute as leaks
from .test_minhash_dedup import LOW
from .test_minhash_dedup import brute as near

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    columns, last = docs.columns, len(corpus_pipeline.STAGES) - 1
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, SF), "test-stage")
        rows = docs.collect()
        after = {r.doc_id for r in rows}
        assert len(after) == len(rows)
        if i < last:
            assert docs.columns == columns and all(before[r.doc_id] == r.text for r in rows)
        if name == "language_id":
            assert all(any(c.isalpha() for c in before[d]) for d in after) and len(after) >= 0.98 * len(before)
        elif name == "exact_dedup":
            top = {}
            for d, t in before.items():
                top[t.translate(LOW)] = max(d, top.get(t.translate(LOW), -1))
            assert after == set(top.values())
        elif name == "near_dedup":
            assert after == {d for d, _, _, kept in near(list(before.items())) if kept}
        elif name == "decontamination":
            assert after == {d for d, t in before.items() if not any(leaks(t, x) for x in items)}
        else:
            assert {r.doc_id: r.decoded_sha256 for r in rows} == {d: hashlib.sha256(t.encode()).hexdigest() for d, t in before.items()}


def test_run_and_columns(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() > 100


NAMES = ["fp", "n", "sha", "row", "k1", "k2", "lang_pred", "accepted", "node", "copies", "_0", "kept", "run"]


def test_nulls_ties_and_clashing_names(spark, tmp_path):
    """Nulls in every column, repeated rows, a very long text and columns with names of our own pass through all stages."""
    real = spark.read.parquet(f"{SF}/documents.parquet").limit(60).select("doc_id", "text", "lang", "source", "n_chars").collect()
    rows = [tuple(r) for r in real] + [
        (None, None, None, None, None), (None, real[0].text, None, None, None), (9001, None, "en", "s", 0), (9002, "", "en", "s", 0),
        (9003, real[1].text * 300, "en", None, 9)
    ]
    rows += [tuple(real[2])] * 3 + [(9004, " 1 2 3 ", None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in NAMES)
    docs = spark.createDataFrame([(*r, *([None] * len(NAMES))) for r in rows], schema)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        columns, before = docs.columns, {(r.doc_id, r.text) for r in docs.collect()}
        docs = corpus_pipeline.materialize(stage(spark, docs, str(tmp_path)), "test-odd")
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and {(r.doc_id, r.text) for r in docs.collect()} <= before
    left = docs.collect()
    assert not {9001, 9002, 9004} & {r.doc_id for r in left} and len({r.decoded_sha256 for r in left}) == len(left) > 20
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, out.collect())) == sorted(map(str, left))


def test_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.collect() == []
