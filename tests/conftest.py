import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadastria.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("*", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """A small DataFrame from rows of dicts with an explicit schema."""
    def make(schema: str, rows: list[dict]):
        names = [f.split()[0] for f in schema.split(", ")]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)

    return make
