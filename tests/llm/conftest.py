import pytest


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def batches(spark):
    from sparkloom.llm.runtime import small_batches

    small_batches(spark, 64)
