"""Batches of long texts stay small in the stages of the pipeline, with the same rows."""

import pandas as pd
import pytest

from tessella.llm.common import SMALL_BATCHES, in_small_batches


@pytest.fixture
def unset(spark):
    for name in SMALL_BATCHES:
        spark.conf.unset(name)
    yield
    for name in SMALL_BATCHES:
        spark.conf.unset(name)


def _sizes(parts):
    for p in parts:
        yield pd.DataFrame({"n": [len(p)], "size": [int(p["text"].str.len().sum())]})


def test_stages_take_few_bytes_at_once(spark, unset, tmp_path):
    import corpus_pipeline

    docs = spark.range(60).selectExpr("id AS doc_id", "'en' AS lang", "'web' AS source", "CAST(300000 AS bigint) AS n_chars", "repeat(concat('word', id, ' '), 300000 div length(concat('word', id, ' '))) AS text").coalesce(1)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    read = spark.read.parquet(f"{tmp_path}/documents.parquet")
    stages = [f for _, f in corpus_pipeline.STAGES]
    for stage in stages:
        for name in SMALL_BATCHES:
            spark.conf.unset(name)
        stage(spark, read, str(tmp_path))
        got = read.mapInPandas(_sizes, "n bigint, size bigint").collect()
        assert sum(r["n"] for r in got) == 60
        assert max(r["size"] for r in got) < 6_000_000  # 18 MB before
    assert stages[1](spark, read, str(tmp_path)).count() == 60


def test_settings_of_the_session_stay(spark, unset):
    name, other = SMALL_BATCHES
    spark.conf.set(name, "1000000")
    in_small_batches(spark)
    assert spark.conf.get(name) == "1000000" and spark.conf.get(other) == SMALL_BATCHES[other]
