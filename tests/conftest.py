import os
import sys
import uuid

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from tidegate.workspace import local_session, scratch_path  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    return scratch_path(spark, "test")


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def set_options(**options):
        for name, value in options.items():
            key = name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_options
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.fixture
def database():
    """An in-memory database inside this JVM; no server and no port."""
    from tidegate.sources.jdbc import Database

    url = f"jdbc:derby:memory:t{uuid.uuid4().hex};create=true"
    return Database(url, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
