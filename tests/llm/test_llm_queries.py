from __future__ import annotations

import check_queries as cq
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from faturaflow.llm import queries

SF = "/root/testdata/sf0.001"


def test_registered():
    names = set(entry.queries())
    assert set(queries.REGISTRY) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.REGISTRY) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash", "mixing", "packing"]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert cq.compare(spark, cq.duck(SF), SF, name) is None


def test_pipeline_against_its_stages(spark, rows_in, tmp_path):
    """Each stage works on its own input; the last one gives all tokens of what the mix kept."""
    from faturaflow.llm import mixing, packing

    docs = spark.createDataFrame(rows_in, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        now.write.parquet(f"{tmp_path}/s{k}")
        now = spark.read.parquet(f"{tmp_path}/s{k}")
    want = packing.op3_pack(now).select("doc_id", "piece", "ids_crc32").collect()
    assert sorted((r.doc_id or 0, r.piece, r.ids_crc32) for r in out) == sorted((r[0] or 0, r[1], r[2]) for r in want)
    assert now.count() > 0 and mixing is not None


def test_pipeline_of_an_empty_table(spark, no_docs, tmp_path):
    no_docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
