"""The pipeline's stages on rows with nulls, empty and long texts, repeated rows, clashing columns, and on no rows."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from figpairs.llm.components import components
from tests.llm.conftest import ROWS, documents

SF = "/root/testdata/sf0.001"
# kept by the quality rules: 50 words or more that do not repeat
TEXT = " ".join(f"one{k}" for k in range(70))
EXTRA = [(20, TEXT, None, "z"), (20, TEXT, None, "z"), (21, TEXT, "en", None), (None, TEXT + " two", "en", "z")]


@pytest.mark.parametrize("rows", [[*ROWS, *EXTRA], []])
def test_every_stage(spark, tmp_path, rows):
    docs = documents(spark, rows)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "token_files":
            assert docs.columns == columns
            kept = {r.doc_id for r in docs.select("doc_id").collect()}
            if rows:
                assert 0 in kept and 7 in kept and 20 in kept  # clean documents stay
            if name == "quality_rules":
                assert not kept & {3, 4, 5, 6, 9, 10}
            elif rows and name == "near_duplicates":
                assert not kept & {1, 2, 21}
                assert docs.where("doc_id = 20").count() == docs.where("doc_id = 7").count() == 2  # rows of one id stay together
    assert docs.count() == (0 if not rows else docs.select(F.count("start")).first()[0])


def test_components_of_odd_links(spark):
    """Nulls link nothing; loops, repeated and turned links count once; no links, no rows."""
    schema = "a long, b long"
    assert components(spark.createDataFrame([], schema)).count() == 0
    links = [(3, 3), (5, 4), (4, 5), (5, 4), (6, 5), (None, 1), (1, None), (9, 8)]
    got = sorted(map(tuple, components(spark.createDataFrame(links, schema)).collect()))
    assert got == [(4, 4), (5, 4), (6, 4), (8, 8), (9, 8)]
