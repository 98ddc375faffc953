"""Every query with an oracle gives DuckDB's rows on the smallest tables; the others run."""

import pytest

from lodestone.plans import registry
from tests.compare import differences, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, con, name):
    df = registry.queries()[name](spark, SF)
    sql = registry.oracles().get(name)
    if sql:
        assert differences(df, con, sql) == ""
    else:
        assert df.count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
