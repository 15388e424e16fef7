"""Every registered query against its DuckDB oracle, and the FIXTURES samples."""

import pytest

import __spark_entry__ as entry_module
from conftest import SF_CHECK, SF_SMALL
from oracle_compare import compare, duck

from cartwheel.plans.oracle import ORACLE_SQL
from cartwheel.plans.registry import QUERIES

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con_small, name):
    df = entry_module.queries()[name](spark, SF_SMALL)
    ok, msg = compare(df, con_small, entry_module.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["basket_size_category", "total_orders", "percentage"]
    assert df.count() > 0


def run(spark, name):
    return [tuple(r) for r in entry_module.queries()[name](spark, SF_CHECK).collect()]


def test_fixture_samples_sf001(spark):
    assert run(spark, "average_basket_size") == [(4.07,)]
    assert run(spark, "product_reorder_rate") == [(33.41,)]
    assert [r[1] for r in run(spark, "orders_by_day_of_week")] == [2125, 2159, 2166, 2124, 2052, 2164, 2210]
    assert set(run(spark, "reorder_interval_distribution")) == {
        (">21 Days", 12196, 81.31), ("Unknown", 1500, 10.0), ("1-7 Days", 456, 3.04),
        ("8-14 Days", 415, 2.77), ("15-21 Days", 401, 2.67), ("Same Day", 32, 0.21)}
    assert set(run(spark, "product_reorder_status")) == {
        ("Reordered", 20042, 33.41), ("Not Reordered", 20026, 33.38), ("Unknown", 19925, 33.21)}
    assert set(run(spark, "basket_size_category")) == {
        ("Small Basket (1-5)", 11523, 78.16), ("Medium Basket (6-10)", 3179, 21.56),
        ("Large Basket (11-20)", 41, 0.28)}
    assert run(spark, "top_ordering_time_windows") == [
        ("Friday", "23:00", 111), ("Monday", "14:00", 109), ("Saturday", "11:00", 109),
        ("Friday", "8:00", 108), ("Saturday", "14:00", 106)]
    largest = run(spark, "largest_basket_orders")
    assert [(r[0], r[5]) for r in largest[:2]] == [(56, 13), (4379, 13)]
    assert run(spark, "top_purchased_products")[:2] == [("red plate", 1379), ("small widget", 1258)]
    assert run(spark, "total_product_line_items") == [(59993,)]
