"""Every stage of the pipeline against a plain version of it."""

import pytest

pytest.importorskip("starpanel.llm.common")
cp = pytest.importorskip("corpus_pipeline")

from starpanel.llm import minhash_dedup, quality, secret_scan  # noqa: E402


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    names = [n for n, _ in cp.STAGES]
    assert names == ["quality classifier", "MinHash near-dedup", "secret scans", "packing"]
    good = spark.createDataFrame(cp.quality_stage(spark, docs, data).collect(), docs.schema)
    model = quality.fit(docs, spark.read.parquet(f"{data}/labels.parquet"), ~quality.held_out())
    want = {r.doc_id for r in quality.score(docs, model).where("score >= 0.3").collect()}
    assert {r.doc_id for r in good.collect()} == want and good.columns == docs.columns
    one = spark.createDataFrame(cp.dedup_stage(spark, good, data).collect(), docs.schema)
    kept = {r.doc_id for r in minhash_dedup.near_dedup(good, 0.8).where("kept").collect()}
    assert {r.doc_id for r in one.collect()} == kept and one.columns == docs.columns
    clean = cp.secrets_stage(spark, one, data).collect()
    for r in clean:
        assert r.text == secret_scan.redacted(rows[r.doc_id].text) and r.n_chars == len(r.text)
        assert not any(secret_scan.spans_of(r.text)[0])
    pieces = cp.packing_stage(spark, spark.createDataFrame(clean, docs.schema), data).collect()
    assert {p.doc_id for p in pieces} == kept
    whole = cp.run(spark, data).collect()
    assert {p.doc_id for p in whole} == kept and sum(p.length for p in whole) == sum(p.length for p in pieces)
