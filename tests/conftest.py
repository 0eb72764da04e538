from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tests.compare import register_views  # noqa: E402
from tests.session import make_session  # noqa: E402
from wayfare.operators.clean import clean_trips  # noqa: E402
from wayfare.sources.trips import read_trips  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # pytest owns the scratch folders of a test run and removes old ones
    session = make_session(**{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF_DIR


@pytest.fixture(scope="session")
def con(sf_dir):
    connection = duckdb.connect()
    register_views(connection, sf_dir)
    return connection


@pytest.fixture(scope="session")
def trips(spark, sf_dir):
    return read_trips(spark, sf_dir)


@pytest.fixture(scope="session")
def cleaned(trips):
    return clean_trips(trips)
