from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
sys.path.insert(0, os.path.dirname(__file__))

from tables import CLEAN_SCHEMA, clean_rows  # noqa: E402

from wattsift.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "wattsift-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def clean_frame(spark):
    return spark.createDataFrame(clean_rows(), CLEAN_SCHEMA)
