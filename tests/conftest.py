import pathlib
import sys
import tempfile

import pytest

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from millrace import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    folder = tempfile.mkdtemp(prefix="millrace-tests-")
    session = build_session(
        "millrace-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": folder + "/shared",
            "spark.sql.warehouse.dir": folder + "/warehouse",
            "spark.local.dir": folder + "/local",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_chunks(spark):
    """Force the split path on small inputs."""
    spark.conf.set("millrace.chunkRows", "40")
    yield 40
    spark.conf.unset("millrace.chunkRows")
