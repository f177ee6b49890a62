import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from barograph.session import local_session

    session = local_session(8, spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


@pytest.fixture(scope="session")
def ctx(spark, folder):
    from barograph.queries import all_queries, context

    all_queries()
    return context(spark, folder)
