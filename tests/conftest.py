from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for folder in (ROOT, os.path.join(ROOT, "tests")):
    if folder not in sys.path:
        sys.path.insert(0, folder)

# Python workers are started with this path, so they can import the test modules.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [ROOT, os.path.join(ROOT, "tests"), os.environ.get("PYTHONPATH", "")]
)

from corpusmix import build_session  # noqa: E402

FLAT = "task string, source_text string, target_text string, source_lang_code string, target_lang_code string"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(row) for row in df.select(*columns or df.columns).collect()), key=repr)
