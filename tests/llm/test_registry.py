import pytest

import corpus_pipeline
from starweave.llm import registry

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_returns_a_row_for_each_input_row(spark, name):
    df = registry.QUERIES[name](spark, SMALL)
    rows = df.count()
    if name == "op13_collocations":  # one row for each phrase
        assert 0 < rows <= 2000 * df.select("lang").distinct().count()
        return
    table = {"op7_multi_index": None, "op10_main_text": "pages"}.get(name, "documents")
    if table:
        assert rows == spark.read.parquet(f"{SMALL}/{table}.parquet").count()
    else:
        queries = spark.read.parquet(f"{SMALL}/embeddings.parquet").where("vec_id % 20 = 0").count()
        assert rows == 20 * queries


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).toArrow())
        assert docs.columns == columns, name
        if name in ("quality", "near_duplicates"):
            assert 0 < docs.count() < before
            before = docs.count()
        elif name == "private_values":
            assert docs.count() == before
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert out.count() == docs.count() and out.where("not exact").count() == 0
