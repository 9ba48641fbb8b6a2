"""The pipeline's stages, each held against a plain model of it on its own input."""

import pytest

import corpus_pipeline
from shelfline.llm.common import materialize
from shelfline.llm.ngram_quality import score_quality
from shelfline.llm.packing import LIMIT
from shelfline.llm.toxicity import fit_toxicity, score_toxicity

from .test_minhash import brute as near_brute
from .test_substring import brute as substring_brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(materialize(stage(spark, kept[-1], SF), "test"))
    return kept


def ids(df):
    return {r["doc_id"] for r in df.collect()}


def test_columns_and_stages(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality classifier", "MinHash near-dedup", "substring dedup", "best-fit packing"]
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes
    assert "sequence_id" in stages[-1].columns


def test_toxicity(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = score_toxicity(stages[0], fit_toxicity(stages[0], labels)).collect()
    assert ids(stages[1]) == {r["doc_id"] for r in scored if r["score"] < 0.5}


def test_quality(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert ids(stages[2]) == {r["doc_id"] for r in score_quality(stages[1], labels).collect() if r["kept"]}


def test_near_dedup(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[2].collect()]
    assert ids(stages[3]) == {k for k, _, _, keep in near_brute(rows) if keep}


def test_substring(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[3].collect()]
    after = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages[4].collect()}
    assert after == {k: (t, len(t)) for k, t, _ in substring_brute(rows)}


def test_packing(stages):
    assert ids(stages[5]) == ids(stages[4])
    fill = {}
    for r in stages[5].collect():
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert max(fill.values()) <= LIMIT


def test_odd_rows(spark, odd, none, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (8, 1, 0), (6, 1, 1), (None, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    docs = none
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, str(tmp_path)), "test")
    assert docs.count() == 0
