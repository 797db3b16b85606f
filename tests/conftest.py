"""One local session for all tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from prospectra.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4, spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluates a column on literals: ``value(fn, "a", None)``."""
    from pyspark.sql import functions as F

    def run(fn, *args):
        out = fn(*[F.lit(a) if not isinstance(a, list) else F.array(*[F.lit(x) for x in a]) for a in args])
        return spark.range(1).select(out.alias("v")).first()["v"]
    return run
