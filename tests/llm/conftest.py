import pytest

from skyledger.llm.storage import ready


@pytest.fixture(autouse=True)
def workers(spark):
    ready(spark)
