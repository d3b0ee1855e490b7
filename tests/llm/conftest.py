import pytest

from tests.llm import tables


@pytest.fixture(scope="session")
def odd(spark):
    return tables.odd_documents(spark)
