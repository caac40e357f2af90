import pytest
from tests.llm import brute


@pytest.fixture(scope="session")
def rows_():
    return brute.awkward()


@pytest.fixture(scope="session")
def docs(spark, rows_):
    return brute.frame(spark, rows_).repartition(5).cache()


@pytest.fixture(scope="session")
def none(spark):
    return brute.frame(spark, [])


@pytest.fixture(scope="session")
def tokenizer():
    from tokenizers import Tokenizer

    from tidemark.llm.tokens import default_vocabulary

    return Tokenizer.from_file(default_vocabulary())
