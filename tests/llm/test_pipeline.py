import sys

from deltafolio.llm import ngram_join, packing, pii, quality
from deltafolio.llm.common import materialize


def test_stages_follow_one_another(spark, sf_dir):
    import __spark_entry__
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    kept = {r["doc_id"] for r in quality.score(docs, labels).where("kept").collect()}
    first = corpus_pipeline.quality_rules(spark, docs, sf_dir)
    assert first.columns == docs.columns and {r["doc_id"] for r in first.collect()} == kept
    second = corpus_pipeline.ngram_jaccard(spark, first, sf_dir)
    alone = {r["component_id"] for r in ngram_join.components(first).collect()}
    assert second.columns == docs.columns and {r["doc_id"] for r in second.collect()} == alone
    third = corpus_pipeline.personal_data(spark, second, sf_dir)
    assert third.columns == docs.columns
    texts = {r["doc_id"]: r for r in third.collect()}
    assert set(texts) == alone
    assert all(not pii.base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in texts.values())
    last = corpus_pipeline.best_fit_packing(spark, third, sf_dir).collect()
    whole = __spark_entry__.queries()["pipeline"](spark, sf_dir).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, last)) == sorted(map(key, whole)) and {r["doc_id"] for r in whole} == alone
    assert packing.CAPACITY == 2048 and "corpus_pipeline" in sys.modules


def test_stages_on_odd_rows_and_empty_tables(spark, odd_docs, no_docs, sf_dir, tmp_path):
    import corpus_pipeline

    for name, docs in (("odd", odd_docs), ("none", no_docs)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.read.parquet(f"{sf_dir}/labels.parquet").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    at = spark.read.parquet(f"{tmp_path}/odd/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        at = materialize(stage(spark, at, f"{tmp_path}/odd"), "stage")
        ids = [r["doc_id"] for r in at.collect()]
        assert at.columns == odd_docs.columns and (k == 0 or len(ids) == len(set(ids)))
    assert ids and all(r["text"] and not pii.base_spans(r["text"]) for r in at.collect())
    assert {r["doc_id"] for r in corpus_pipeline.best_fit_packing(spark, at, "").collect()} == set(ids)
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
