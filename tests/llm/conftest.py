import pytest


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.01"
