import pytest

from llm_cases import MESSY, messy_rows


@pytest.fixture(scope="session")
def messy(spark):
    """Null ids and texts, repeated rows, equal ids, very long and odd texts, clashing names."""
    return spark.createDataFrame(messy_rows(), MESSY)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], MESSY)
