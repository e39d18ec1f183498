from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortspark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        "8",
        "tests",
        **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture()
def rows():
    """Sorted plain tuples of a frame."""

    def collect(df, *columns):
        out = df.select(*columns).collect() if columns else df.collect()
        return sorted((tuple(r) for r in out), key=lambda r: [(v is None, str(type(v)), v) for v in r])

    return collect
