"""Properties of the driver's tables that let the facts skip joins and work in whole cents."""

import pytest

FOREIGN_KEYS = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
]


@pytest.mark.parametrize(("child", "key", "parent", "parent_key"), FOREIGN_KEYS)
def test_every_key_has_exactly_one_parent(spark, folder, child, key, parent, parent_key):
    children = spark.read.parquet(f"{folder}/{child}.parquet")
    parents = spark.read.parquet(f"{folder}/{parent}.parquet")
    assert children.join(parents, children[key] == parents[parent_key], "left_anti").count() == 0
    assert parents.select(parent_key).distinct().count() == parents.count()


def test_price_and_discount_have_two_decimals(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    exact = "cast(cast(rint({0} * 100) as bigint) as decimal(20,0)) * 0.01BD = cast({0} as decimal(24,6))"
    assert lines.filter(f"not ({exact.format('l_extendedprice')} and {exact.format('l_discount')})").count() == 0
