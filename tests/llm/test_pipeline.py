import os
import re

import corpus_pipeline
from clickmarts.llm.decontaminate import contamination_report
from clickmarts.llm.ngram_join import jaccard_components
from clickmarts.llm.pii import base_spans

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, seen[-1], SF)
        out.write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
    for df in seen[1:-1]:
        assert df.columns == docs.columns
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    langs = {r["doc_id"] for r in seen[1].collect()}
    assert set(given) - langs <= {d for d, t in given.items() if not re.search(r"[^\W\d_]", t) or len(t) < 40}
    expect = {r["doc_id"] for r in jaccard_components(seen[1], 5, 4, 5).where("doc_id = component_id").collect()}
    assert {r["doc_id"] for r in seen[2].collect()} == expect
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    hit = {r["doc_id"] for r in contamination_report(seen[2], bench).where("contaminated").collect()}
    before = {r["doc_id"]: r["text"] for r in seen[2].collect()}
    after = {r["doc_id"]: r for r in seen[3].collect()}
    assert set(before) == set(after)
    assert {d for d in before if before[d] != after[d]["text"]} == hit
    assert all(r["n_chars"] == len(r["text"]) for r in after.values())
    clean = {r["doc_id"]: r["text"] for r in seen[4].collect()}
    assert set(clean) == set(after) and not any(base_spans(t) for t in clean.values())
    assert {r["doc_id"] for r in seen[5].collect()} == set(clean)


def test_run_and_empty_input(spark, tmp_path):
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5
    assert corpus_pipeline.run(spark, SF).count() > 0
    os.makedirs(tmp_path / "sf")
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / "sf" / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "sf")).count() == 0
