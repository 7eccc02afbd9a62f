import pytest
from pyspark.sql import functions as F

import catalog
from corpusmix import session


def test_the_folder_is_the_one_the_session_names(spark):
    assert session.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    written = session.materialize(spark.range(5), "stage")
    assert written.count() == 5
    assert all(session.shared_folder(spark) in name for name in written.inputFiles())


def test_a_local_session_without_the_setting_gets_its_own(spark, monkeypatch):
    monkeypatch.setattr(session, "CHECKPOINT_SETTING", "spark.corpusmix.not.set")
    folder = session.shared_folder(spark)
    assert folder == session.shared_folder(spark) != spark.conf.get("spark.checkpoint.dir")


def test_a_cluster_must_name_its_folder(monkeypatch):
    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())


def test_packages_are_shipped_once(spark):
    session.ship_packages(spark, catalog)
    before = len(spark.sparkContext.listFiles)
    session.ship_packages(spark, catalog)
    assert len(spark.sparkContext.listFiles) == before


def test_stages_of_a_build_are_written_with_zstd(spark):
    written, counts = session.materialize_counted(spark.range(5), "stage", rows=F.count("*"))
    assert counts == {"rows": 5}
    assert written.inputFiles() and all(name.endswith(".zstd.parquet") for name in written.inputFiles())
