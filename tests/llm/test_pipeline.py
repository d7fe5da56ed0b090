"""The stages one after another on the smallest table."""

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_follow_each_other(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    docs, sizes = source, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == source.columns
        sizes.append(docs.count())
    assert sizes[0] < source.count() and sizes[0] == sizes[1] and sizes == sorted(sizes, reverse=True)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.select("doc_id").distinct().count() == docs.count()
