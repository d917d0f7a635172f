"""The raw feed moves few bytes: small sides are broadcast by their measured
size, and the rows are the same without it."""
import pytest

from tessera.operators import star
from tessera.sources.fixture import bronze_from_tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def no_automatic_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_lineitem_is_shuffled_for_orders_alone(spark, sf001, no_automatic_broadcast):
    lean, wide = bronze_from_tables(spark, sf001), bronze_from_tables(spark, sf001, max_broadcast_bytes=-1)
    p = plan(lean)
    # The parents come first: the names of parts are broadcast to the shuffled join with orders.
    assert p.count("BroadcastHashJoin") == 2
    assert p.index("BroadcastHashJoin [l_partkey") < p.index("SortMergeJoin [l_orderkey")
    assert "BroadcastHashJoin" not in plan(wide)
    assert lean.exceptAll(wide).count() == wide.exceptAll(lean).count() == 0


def test_small_sides_share_one_budget():
    assert star.within_budget({"a": 70, "b": 40, "c": 10}, 100) == {"b", "c"}
    assert star.within_budget({"a": 70}, 10) == set()
