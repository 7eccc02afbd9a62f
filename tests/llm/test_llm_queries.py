"""The registered queries on whole small tables, against SQL where there is some."""

import pytest

import corpus_pipeline
from corpusmix.llm.oracle import ORACLE
from corpusmix.llm.queries import QUERIES
from oracle_check import connect, differences


# Those of test_llm_mining.py have numbers that may be null, and are compared there.
@pytest.mark.parametrize("name", ["op4_chat_formatting", "op6_quality_rules"])
def test_query_equals_its_sql(spark, tables, name):
    expected = connect(tables).execute(ORACLE[name]).df()
    assert differences(QUERIES[name](spark, tables).toPandas(), expected) is None


def test_native_queries_run_no_python(spark, tables):
    for name in ("op4_chat_formatting", "op6_quality_rules", "op7_url_filters", "op8_pii"):
        plan = QUERIES[name](spark, tables)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "InArrow", "InPandas", "Cartesian")), name


def test_stages_keep_the_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), tables).columns == docs.columns
    assert len(corpus_pipeline.STAGES) == 5
