import os
import sys
import tempfile
import uuid

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import SF_DIR  # noqa: E402

from rateloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    settings = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    session = build_session("tests", "local[8]", **settings)
    if not session.conf.get("spark.checkpoint.dir", None):
        session.stop()
        settings["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="rateloom-tests-")
        session = build_session("tests", "local[8]", **settings)
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def sf_dir():
    return SF_DIR


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


@pytest.fixture
def other_zone(spark):
    """The session in a zone with daylight saving, for results that must not depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


# Classes of the tests travel by value too: executors do not have this folder on their path.
def pytest_collection_modifyitems(items):
    from pyspark import cloudpickle

    for module in {item.module for item in items}:
        cloudpickle.register_pickle_by_value(module)
