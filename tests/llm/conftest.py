import pytest

from tessera.llm.common import small_batches


@pytest.fixture(scope="session", autouse=True)
def batches(spark):
    small_batches(spark)
