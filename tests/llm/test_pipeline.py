"""The pipeline against its stages' contracts on the smallest table."""

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_in_order(spark, tmp_path):
    docs, ids = spark.read.parquet(f"{SF}/documents.parquet"), None
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        if k < 4:
            assert docs.columns == corpus_pipeline.COLUMNS and docs.count() == len(now)
        assert ids is None or now <= ids and (k < 3 or now == ids)
        ids = now
    assert docs.where("bin IS NULL OR bin_start + size > bin_length").count() == 0


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), stage(spark, docs, SF).schema)
        assert docs.count() == 0
