import pytest

from tidemark.llm.common import prepare


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    return prepare(spark)
