"""One Spark session and, for each test, an empty lake."""

import os
from pathlib import Path

import pytest

from tidegate.lake import Lake
from tidegate.session import build_session

# Python workers of the session import the library from here, wherever the tests were started.
os.environ["PYTHONPATH"] = str(Path(__file__).resolve().parents[1])


@pytest.fixture(scope="session")
def spark(tmp_path_factory, request):
    session = build_session(
        "tidegate-tests",
        "local[4,2]",  # a failed task is tried once more, as on a cluster
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoint")),
    )
    session.sparkContext.setLogLevel("ERROR")
    request.addfinalizer(session.stop)
    return session


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"), "points")
