import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from chatsieve.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("4", shuffle_partitions=4, memory="6g")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
