from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from lendscape.session import local_session  # noqa: E402
from lendscape.sources.derived_loans import loans  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def portfolio_path(spark, sf_dir, tmp_path_factory):
    """The derived portfolio, written once."""
    path = str(tmp_path_factory.mktemp("portfolio") / "loans")
    loans(spark, sf_dir).write.parquet(path)
    return path


@pytest.fixture
def book(spark, portfolio_path):
    return spark.read.parquet(portfolio_path)


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
