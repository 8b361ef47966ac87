"""The pipeline's stages on a small table, one after another and each on its own."""

import re

import corpus_pipeline
from storyloom.llm.ngram_join import ngram_components

SF = "/root/testdata/sf0.001"


def test_stages_return_documents_and_run_packs_what_they_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line dedup", "n-gram join", "pii", "packing"]
    left, ids = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, left, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        left = corpus_pipeline.materialize(out, "test-stage")
        ids.append(left.count())
    assert ids == sorted(ids, reverse=True) and ids[0] > ids[-1] > 0
    texts = {r["doc_id"]: r["text"] for r in left.collect()}
    packed = corpus_pipeline.run(spark, SF).collect()
    words = {}
    for x in packed:
        words[x["doc_id"]] = words.get(x["doc_id"], 0) + x["n_words"]
    assert words == {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t in texts.items()}
    assert corpus_pipeline.ORACLE_SQL is None


def test_near_copies_do_not_survive_the_third_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    found = ngram_components(kept, 5, 80, 100).where("n_shingles > 0")
    assert found.count() == found.select("component_id").distinct().count()
