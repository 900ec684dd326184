from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from hirelake.session import build_session

    s = build_session("local[*]", 8, app_name="hirelake-tests")
    yield s
    s.stop()


@pytest.fixture()
def rows(spark):
    """Build a DataFrame from python rows with a DDL schema."""

    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make
