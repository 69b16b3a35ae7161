import pytest


@pytest.fixture(scope="session", autouse=True)
def written_tables(spark):
    yield
    from stakeflow.llm.tables import drop_written
    drop_written(spark)
