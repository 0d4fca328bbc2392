import pytest


@pytest.fixture(scope="session", autouse=True)
def package_path(spark):
    from aisleflow.llm.common import reach_package

    reach_package(spark)
