"""Published tables, the ledger of stages, and reports from counts taken while writing."""

import json
import os
from functools import partial

import pytest
from pyspark.sql import functions as F

from catalog import bindings
from conftest import rows
from corpusmix import session
from corpusmix.plans import corpus, prepared
from corpusmix.sources import published, readers, sinks


def split_rows(spark, count, test_every=10):
    is_test = F.col("id") % test_every == 0
    return spark.range(count).select(
        "id", F.sha1(F.col("id").cast("string")).alias("pair_hash"), F.when(is_test, "test").otherwise("train").alias("split")
    )


def files(path, version, part):
    folder = f"{path}/data/{version.id}/{part.folder}"
    return [name for name in os.listdir(folder) if name.endswith(".parquet")]


def test_each_write_is_a_version_and_readers_see_the_last(spark, tmp_path):
    path = str(tmp_path / "t")
    first, second = split_rows(spark, 1000).repartition(4), split_rows(spark, 30)
    one = sinks.write_prepared(first, path)
    held = readers.read_prepared(spark, path, "all")
    two = sinks.write_prepared(second, path)
    assert (one.version, two.version) == (1, 2)
    assert rows(readers.read_prepared(spark, path, "all"), *second.columns) == rows(second)
    assert rows(held, *first.columns) == rows(first)
    assert rows(readers.read_prepared(spark, path, "test"), "id") == [(0,), (10,), (20,)]
    assert readers.read_prepared(spark, path, "none").columns == ["id", "pair_hash", "split"]
    assert readers.read_prepared(spark, path, "none").count() == 0
    assert published.clean_up(spark, path) == [one.id]
    assert rows(readers.read_prepared(spark, path, "all"), *second.columns) == rows(second)


def test_files_follow_from_row_counts(spark, tmp_path):
    path = str(tmp_path / "t")
    version = sinks.write_prepared(split_rows(spark, 4000).repartition(16), path, rows_per_file=150)
    parts = {part.split: part for part in version.parts}
    assert parts["test"].rows == 400 and parts["train"].rows == 3600
    # 16 tasks met test rows; three files hold them. The train files are near what is needed and stay.
    assert len(files(path, version, parts["test"])) == 3 == parts["test"].files
    assert len(files(path, version, parts["train"])) == 32
    listed = spark.read.parquet(f"{path}/data/{version.id}/files").groupBy("split").agg(F.sum("rows"), F.count("*"))
    assert rows(listed) == [("test", 400, 3), ("train", 3600, 32)]


@pytest.mark.parametrize("failing", ["parquet", "json"])
def test_a_write_that_fails_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch, failing):
    path = str(tmp_path / "t")
    before = split_rows(spark, 100)
    sinks.write_prepared(before, path)
    if failing == "parquet":  # a task fails while rows are written
        broken = split_rows(spark, 100).withColumn(
            "pair_hash", F.when(F.col("id") == 77, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("pair_hash"))
        )
    else:  # everything is written but the document
        broken = split_rows(spark, 50)
        monkeypatch.setattr(published, "_commit", partial(fail))
    with pytest.raises(Exception, match="lost"):
        sinks.write_prepared(broken, path)
    monkeypatch.undo()
    assert len(os.listdir(f"{path}/data")) == 2
    assert rows(readers.read_prepared(spark, path, "all"), *before.columns) == rows(before)
    assert len(published.clean_up(spark, path)) == 1 == len(os.listdir(f"{path}/data"))
    again = sinks.write_prepared(split_rows(spark, 7), path)
    assert again.version == 2 and readers.read_prepared(spark, path, "all").count() == 7


def fail(*_):
    raise OSError("lost")


def test_a_half_written_document_does_not_count(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_prepared(split_rows(spark, 20), path)
    os.makedirs(f"{path}/versions/v=2/_temporary/0")
    os.makedirs(f"{path}/versions/v=3")
    with open(f"{path}/versions/v=3/part-00000.json", "w", encoding="utf-8") as out:
        out.write('{"version": 3, "id": "x", "sh')
    assert published.current_version(spark, path).version == 1
    assert published.clean_up(spark, path) == []
    assert sorted(os.listdir(f"{path}/versions")) == ["v=1"]
    assert sinks.write_prepared(split_rows(spark, 5), path).version == 2


def test_a_shuffled_table_is_read_back_in_its_order(spark, tmp_path):
    path = str(tmp_path / "t")
    df = split_rows(spark, 3000)
    version = sinks.write_prepared(df.repartition(7), path, shuffled=True, rows_per_file=200)
    assert version.shuffled and sum(part.files for part in version.parts) >= 15
    drawn = df.withColumn("draw", published.shuffle_key()).collect()
    for split in ("train", "test"):
        expected = [r["id"] for r in sorted(drawn, key=lambda r: r["draw"]) if r["split"] == split]
        got = published.read_in_order(spark, path, split)
        assert "Exchange rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
        found = sorted(got.collect(), key=lambda r: r["row_at"])
        assert [r["row_at"] for r in found] == list(range(len(expected)))
        assert [r["id"] for r in found] == expected
    other = sinks.write_prepared(df.repartition(3).orderBy("id"), str(tmp_path / "u"), shuffled=True, rows_per_file=450)
    one = rows(published.read_in_order(spark, str(tmp_path / "u"), "train", other), "row_at", "id")
    assert one == rows(published.read_in_order(spark, path, "train"), "row_at", "id")


def test_odd_tables(spark, tmp_path):
    empty = sinks.write_prepared(split_rows(spark, 10).limit(0), str(tmp_path / "a"))
    assert empty.parts == () and readers.read_prepared(spark, str(tmp_path / "a"), "all").count() == 0
    assert sinks.write_prepared(split_rows(spark, 10).limit(0), str(tmp_path / "b"), shuffled=True).parts == ()
    null = split_rows(spark, 9).withColumn("split", F.lit(None).cast("string"))
    sinks.write_prepared(null, str(tmp_path / "c"))
    assert rows(readers.read_prepared(spark, str(tmp_path / "c"), "all"), "id", "split") == rows(null, "id", "split")
    with pytest.raises(ValueError, match="plain name"):
        sinks.write_prepared(null.withColumn("split", F.lit("a/b")), str(tmp_path / "d"))
    with pytest.raises(ValueError, match="nothing"):
        published.current_version(spark, str(tmp_path / "none"))


# --- the ledger --------------------------------------------------------------------------------


def test_stages_go_when_the_last_holder_lets_go(spark):
    with session.stages(spark) as ledger:
        table = session.materialize(spark.range(10), "a")
        assert all(ledger.folder in name for name in table.inputFiles())
        with session.stages(spark) as inner:
            session.materialize(spark.range(3), "b")
            assert inner.folder != ledger.folder
        assert not session.path_exists(spark, inner.folder)
        held = ledger.hold()
        held.__enter__()
    assert table.count() == 10 and session.path_exists(spark, ledger.folder)
    held.__exit__(None, None, None)
    assert not session.path_exists(spark, ledger.folder)
    with pytest.raises(ValueError, match="released"), ledger.hold():
        pass
    outside = session.materialize(spark.range(3), "c")
    assert outside.count() == 3 and ledger.folder not in outside.inputFiles()[0]


def test_stages_go_when_the_block_fails(spark):
    with pytest.raises(KeyError), session.stages(spark) as ledger:
        session.materialize(spark.range(10), "a")
        raise KeyError
    assert not session.path_exists(spark, ledger.folder)


def test_a_build_leaves_no_stages_and_reports_without_reading(spark, tables, tmp_path):
    path = str(tmp_path / "out")
    top = f"{session.shared_folder(spark)}/corpusmix"
    before = set(session.folder_names(spark, top))
    with corpus.build_corpus(spark, bindings.RECIPE, bindings.load(tables)) as built:
        assert session.path_exists(spark, built.ledger.folder)
        expected = built.summary().collect()
        version = built.write(path, shuffled=True)
        summary = built.summary()
        plan = summary._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "FileScan" not in built.removed_counts()._jdf.queryExecution().executedPlan().toString()
        assert summary.collect() == expected
        assert version.counts["total_rows"] == built.split.count() == sum(part.rows for part in version.parts)
        assert built.counts["pool_rows"] == built.pool.count() and built.counts["unique_rows"] == built.unique.count()
    assert not session.path_exists(spark, built.ledger.folder)
    assert set(session.folder_names(spark, top)) == before
    document = [name for name in os.listdir(f"{path}/summary") if name.endswith(".json")]
    assert json.load(open(f"{path}/summary/{document[0]}"))["total_rows"] == expected[0]["total_rows"]
    assert readers.read_prepared(spark, f"{path}/prepared", "all").count() == expected[0]["total_rows"]
    assert prepared.training_rows(spark, f"{path}/prepared").count() == expected[0]["training_split_rows"]
