import corpus_pipeline


def test_stages_keep_the_columns(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(out := f"{tmp_path}/{k}")
        docs = spark.read.parquet(out)
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
        assert 0.5 * before < docs.count() <= before
