import pytest

from cartwheel.operators.facts import build_fact_order_products, build_fact_orders
from cartwheel.plans.quality import LoadValidationError, validate_load


def gate(spark, rows):
    schema = ("source_file string, order_id string, user_id string, order_number string, "
              "order_dow string, order_hour_of_day string, days_since_prior_order string, "
              "eval_set string, products string")
    raw = spark.createDataFrame(rows, schema)
    return validate_load(build_fact_orders(raw), build_fact_order_products(raw))


def row(f="a", oid="1", dow="1", hour="7"):
    return (f, oid, "1", "1", dow, hour, None, "prior", '[{"product_id":1}]')


def test_passes(spark):
    report = gate(spark, [row(), row(oid="2")])
    assert (report.orders_count, report.products_count) == (2, 2)


def test_empty(spark):
    with pytest.raises(LoadValidationError, match="empty"):
        gate(spark, [row(oid=None)])


@pytest.mark.parametrize("rows,match", [
    ([row("a"), row("b")], "duplicate"),
    ([row(dow="7")], "order_dow"),
    ([row(hour="24")], "order_hour"),
    # precedence: duplicates reported before a bad day and a bad hour
    ([row("a", dow="9", hour="-1"), row("b", dow="9", hour="-1")], "duplicate"),
    ([row(dow="-1", hour="25")], "order_dow"),
])
def test_rules_in_order(spark, rows, match):
    with pytest.raises(LoadValidationError, match=match):
        gate(spark, rows)
