import pytest

from quotemill.session import local_session

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(8, 4)


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture(scope="session")
def tables(spark, folder):
    from quotemill.sources.domain import Domain

    return Domain(spark, folder)


def rows(df):
    return sorted(tuple(r) for r in df.collect())
