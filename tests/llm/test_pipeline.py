import corpus_pipeline
from cases import clashing, docs, empty, rows

from tagloom.llm import decontam, ngram_join, quality
from tagloom.llm.common import staged, table


def test_stages_on_the_test_documents(spark):
    sf = "/root/testdata/sf0.001"
    d = table(spark, sf, "documents")
    kept = {r["doc_id"] for r in quality.quality_scores(d, table(spark, sf, "labels")).filter("predicted = 1").collect()}
    columns, before = d.columns, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = staged(stage(spark, d, sf), f"test-{name}")
        assert d.columns == columns
        ids = {r["doc_id"] for r in d.collect()}
        if name == "quality":
            assert ids == kept
        else:
            assert ids <= before
        if name == "near_duplicates":
            left = ngram_join.ngram_join(d).collect()
            assert all(r["n_links"] == 0 for r in left)
        if name == "benchmark":
            report = decontam.contamination_report(d, table(spark, sf, "benchmark"))
            assert not report.filter("contaminated").count()
        before = ids
    packed = corpus_pipeline.STAGES[-1][1](spark, d, sf)
    assert {r["doc_id"] for r in packed.collect()} == before
    whole = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in whole.collect()} == before


def test_odd_rows_go_through_all_stages(spark, tmp_path):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench = [(1, rows(1)[4][1]), (None, None)]
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clashing(docs(spark, 1)).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 20
    empty(spark).write.parquet(f"{tmp_path}/e/documents.parquet")
    labels.write.parquet(f"{tmp_path}/e/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/e/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/e").count() == 0
