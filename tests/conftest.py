import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from oracle import session

    return session()


@pytest.fixture(scope="session")
def con():
    from oracle import connect
    from support import SF

    return connect(SF)


@pytest.fixture
def conf(spark):
    """Settings for one test, put back afterwards."""
    before = {}

    def put(name, value):
        before.setdefault(name, spark.conf.get(name, None))
        spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)
