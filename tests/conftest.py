import pytest

from skyledger.operators.shared import drop_scratch
from skyledger.session import local_session
from tests.compare import engine

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def con(sf_dir):
    return engine(sf_dir)


def rows(df, *order):
    """All rows as tuples; sorted when columns to sort by are given."""
    found = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return found if order else sorted(found, key=repr)
