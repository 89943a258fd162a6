"""The registered queries against DuckDB, and what their plans must not hold."""

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from plans_helper import plan_of
from ratewise.plans.oracle_sql import ORACLES
from ratewise.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert entry.queries().keys() >= QUERIES.keys()
    assert len(ORACLES) >= 55


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    plan = plan_of(df)
    assert "Python" not in plan and "Pandas" not in plan
    # The only products are MLlib's own, of blocks of user and item factors.
    if not name.startswith("recommend"):
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    got = df.toPandas()
    if name in ORACLES:
        assert compare(got, duck.execute(ORACLES[name]).df()) is None
    else:
        assert len(got) > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert len(df.collect()) == 10
    assert "title" in df.columns


def test_columns_are_pruned_at_the_scan(spark, sf):
    """Six of eleven line columns and two of six order columns."""
    plan = plan_of(QUERIES["popular_items_orders"](spark, sf))
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan
    assert "IsNotNull(l_orderkey)" in plan
