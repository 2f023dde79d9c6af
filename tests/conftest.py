import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from check import session, sql_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return session("4")


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def sql():
    return sql_session(SMALL)


@pytest.fixture
def folder(spark):
    from haulframe.sources.scratch import new_path

    return lambda label: new_path(spark, label)
