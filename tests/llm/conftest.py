import pytest

from bondscope.session import drop_database


@pytest.fixture(scope="module", autouse=True)
def staged_databases_go(spark):
    """Operators stage tables that go with the session; here one session serves tests that count them."""

    def staged():
        return {d.name for d in spark.catalog.listDatabases() if d.name.startswith("bondscope_")}

    before = staged()
    yield
    for name in staged() - before:
        drop_database(spark, name)
