import pytest

from cartwheel.operators.facts import build_fact_order_products
from conftest import raw_frame

NO_ROWS = [None, "", "  ", "not json", '[{"product_id":1', "[]", "{}", '{"product_id":1}',
           "5", '"x"', '["x"]', "[[1]]"]


def products_of(spark, cells):
    rows = [(str(i + 1), "1", "1", "0", "0", None, "prior", c) for i, c in enumerate(cells)]
    fp = build_fact_order_products(raw_frame(spark, rows))
    return fp.orderBy("order_id", "add_to_cart_order").collect()


@pytest.mark.parametrize("cell", NO_ROWS)
def test_cells_without_products(spark, cell):
    assert products_of(spark, [cell]) == []


def test_non_objects_are_skipped(spark):
    got = products_of(spark, ['[1,{"product_id":2}]', '[null,{"product_id":2}]'])
    assert [(r.order_id, r.product_id) for r in got] == [(1, 2), (2, 2)]


def test_empty_object_gives_defaults(spark):
    (row,) = products_of(spark, ["[{}]"])
    assert row.product_id is None and row.add_to_cart_order is None and row.reordered is None
    assert (row.product_name, row.aisle, row.department) == ("", "", "")


def test_field_coercion(spark):
    got = products_of(spark, [
        '[{"product_id":"3","product_name":5}]',
        '[{"product_id":null,"product_name":null}]',
        '[{"product_id":1.0}]',
        '[{"reordered":true}]',
        '[{"product_id":1.5,"add_to_cart_order":"2"}]',
    ])
    assert (got[0].product_id, got[0].product_name) == (3, "5")
    assert (got[1].product_id, got[1].product_name) == (None, "")
    assert got[2].product_id == 1
    assert got[3].reordered == 1
    assert (got[4].product_id, got[4].add_to_cart_order) == (None, 2)


def test_duplicate_keys_keep_first(spark):
    cell = ('[{"product_id":7,"add_to_cart_order":1,"product_name":"first"},'
            '{"product_id":7,"add_to_cart_order":1,"product_name":"second"},'
            '{"add_to_cart_order":2,"product_name":"a"},{"add_to_cart_order":2,"product_name":"b"}]')
    got = products_of(spark, [cell])
    assert [(r.product_id, r.add_to_cart_order, r.product_name) for r in got] == [
        (7, 1, "first"), (None, 2, "a")]


def test_duplicate_json_keys_last_wins(spark):
    (row,) = products_of(spark, ['[{"product_id":1,"product_id":2}]'])
    assert row.product_id == 2


def test_orders_without_order_id_give_no_products(spark):
    rows = [(None, "1", "1", "0", "0", None, "prior", '[{"product_id":1}]'),
            ("x", "1", "1", "0", "0", None, "prior", '[{"product_id":1}]')]
    assert build_fact_order_products(raw_frame(spark, rows)).count() == 0
