import pytest


@pytest.fixture(autouse=True)
def tidy(spark):
    """Intermediate tables are gone after each test."""
    yield
    from wattlake.session import release_scratch

    release_scratch(spark)
