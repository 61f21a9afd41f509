"""Every stage of the pipeline on odd rows: nulls, empty and long texts, repeated rows, no rows, clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"
ROWS = [
    (1, "A text of some ordinary words, mail jo@x.org and 97.51.17.173.", "en", "web", 9),
    (1, "A text of some ordinary words, mail jo@x.org and 97.51.17.173.", "en", "web", 9),
    (2, None, None, None, None),
    (3, "", "en", "web", 0),
    (4, " \n\t", None, "web", 3),
    (None, "No id but words that are as good as those of others.", "en", None, 5),
    (5, "word " * 40_000, "de", "books", 200_000),
    (6, "日本語 é x@y" + "." * 50, "xx", "", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the stages use for columns of their own.
CLASHING = ["size", "es_key", "copies", "taken", "target", "posterior", "keep", "log_odds", "n_words", "k1", "root", "ids", "decoded", "pseudonymised"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, docs, name, stage):
    wide = docs.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)})
    last = name == corpus_pipeline.STAGES[-1][0]
    plain = stage(spark, docs, SMALL)
    clashing = stage(spark, wide, SMALL)
    if not last:
        assert plain.columns == docs.columns and clashing.columns == wide.columns
        for i, c in enumerate(CLASHING):
            assert clashing.where(F.col(c) != i).count() == 0
    got = sorted(map(str, (tuple(r) for r in plain.collect())))
    assert got == sorted(str(tuple(r)) for r in clashing.select(*plain.columns).collect())
    if name == "private_values":
        assert len(got) == len(ROWS) and not any("97.51.17.173" in g or "jo@x.org" in g for g in got)
    elif name == "near_duplicates":
        # One of the equal rows goes; texts without words are no copies of each other.
        assert len(got) == len(ROWS) - 1
    elif name == "tokens":
        assert len(got) == len(ROWS) and plain.where("NOT exact").count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_no_rows(spark, docs, name, stage):
    assert stage(spark, docs.limit(0), SMALL).count() == 0
