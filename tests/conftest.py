import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sightline import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    built = session.build(
        "sightline-tests", master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "6g"},
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built


@pytest.fixture()
def folder(spark):
    return session.scratch_path(spark, "test")


@pytest.fixture()
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def put(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, str(value))

    yield put
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)
