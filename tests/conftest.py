"""One local session for all tests."""

import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from assay.session import build_session, release_run, shared_root  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[*]",
        spark_sql_shuffle_partitions="4", spark_ui_enabled="false", spark_driver_memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_run(session, f"{shared_root(session)}/assay/{session.sparkContext.applicationId}")
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="assay-test-")


@pytest.fixture
def plan_of():
    """Text of the physical plan, after running it when ``final``."""

    def text(df, final=False):
        execution = df._jdf.queryExecution()
        if final:
            df.write.format("noop").mode("overwrite").save()
            df.collect()
        return execution.executedPlan().toString()

    return text
