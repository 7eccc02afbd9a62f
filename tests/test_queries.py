"""Every registered query against its SQL, and what the plans must not contain."""

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog.oracle import ORACLE
from catalog.queries import QUERIES
from oracle_check import connect, differences

PYTHON_SLOTS = {"q01b_sources_of_each_format", "q10b_batch_tokenizer_lengths", "q28c_whole_evaluation", "q32_batch_scorer"}


@pytest.fixture(scope="module")
def duck(tables):
    return connect(tables)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, tables, duck, name):
    result = queries()[name](spark, tables)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_SLOTS:
        assert "Python" not in plan and "InPandas" not in plan
    expected = duck.execute(oracle_sql()[name]).df()
    assert differences(result.toPandas(), expected) is None


@pytest.mark.parametrize("name", ["q06_usage_slice_union"])
def test_documents_of_any_language_take_part(spark, tables, tmp_path, name):
    for path in sorted(Path(tables).glob("*.parquet")):
        (tmp_path / path.name).symlink_to(path)
    (tmp_path / "documents.parquet").unlink()
    other = "CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 7 = 1 THEN 'it' ELSE lang END"
    connect(tables).execute(
        f"COPY (SELECT * REPLACE ({other} AS lang) FROM documents) TO '{tmp_path}/documents.parquet'"
    )
    result = queries()[name](spark, str(tmp_path)).toPandas()
    assert (result["dataset_source"] == "texts_other").any()
    assert differences(result, connect(str(tmp_path)).execute(oracle_sql()[name]).df()) is None
