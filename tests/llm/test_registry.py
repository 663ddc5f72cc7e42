"""The registered queries over the whole small tables, against SQL where there is one."""

import duckdb
import pytest
from conftest import TESTDATA

from __spark_entry__ import oracle_sql, queries
from tripflow.llm.registry import ORACLE, QUERIES


def test_one_query_per_operator():
    numbers = sorted(int(name.split("_")[0][2:]) for name in QUERIES)
    assert numbers == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(name, spark):
    result = queries()[name](spark, TESTDATA)
    sql = duckdb.connect()
    for table in ("documents", "labels", "benchmark", "pages", "conversations"):
        sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{TESTDATA}/{table}.parquet'")
    expected = sql.sql(oracle_sql()[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    places = [expected.columns.index(c) for c in columns]
    ours = sorted(repr([row[c] for c in columns]) for row in result.collect())
    assert ours == sorted(repr([row[p] for p in places]) for row in expected.fetchall())


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline
    from tripflow.llm import decontaminate, near_copies, quality_rules

    docs = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, before, TESTDATA), "stage")
        assert docs.columns == columns
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left <= ids
        if name == "quality rules":
            labels = spark.read.parquet(f"{TESTDATA}/labels.parquet")
            kept = quality_rules.quality_rules(before, labels).where("kept").collect()
            assert left == {r.doc_id for r in kept}
        if name == "n-gram Jaccard join":
            rows = near_copies.jaccard_join(before, 5, 80).collect()
            assert left == {r.component_id for r in rows}
        if name == "benchmark decontamination":
            benchmark = spark.read.parquet(f"{TESTDATA}/benchmark.parquet")
            assert left == ids - {r.doc_id for r in decontaminate.leaks(before, benchmark).collect()}
        if name == "secret scans":
            assert docs.where("text like '%[SECRET]%'").count() > 0
            assert docs.where("text rlike 'token = .[0-9a-f]{40}'").count() == 0
            assert docs.where("n_chars <> length(text)").count() == 0
        ids = left
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, TESTDATA).collect()
    assert {r.doc_id for r in mixed} == ids
    assert sum(r.taken for r in mixed) == pytest.approx(1.5 * sum(r["size"] for r in mixed), abs=20)


def test_executors_need_no_copy_of_the_package():
    from pyspark import cloudpickle

    from tripflow.llm import lang_id

    assert b"OTHERS" in cloudpickle.dumps(lang_id.letters)
