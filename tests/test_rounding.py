"""The published golden: 200 orders, 2,405 product rows, 1,470 reordered."""

import json

from cartwheel.operators.facts import build_fact_order_products, build_fact_orders
from cartwheel.plans import dashboard as Q
from conftest import raw_frame


def golden_raw(spark):
    rows, item, reordered_left = [], 0, 1470
    for order in range(1, 201):
        size = 13 if order <= 5 else 12   # 5 * 13 + 195 * 12 = 2405
        products = []
        for pos in range(1, size + 1):
            item += 1
            flag = 1 if reordered_left > 0 else 0
            reordered_left -= flag
            products.append({"product_id": item, "product_name": f"p{item % 17}",
                             "aisle": "a", "department": "d",
                             "add_to_cart_order": pos, "reordered": flag})
        rows.append((str(order), str(order % 37), "1", str(order % 7), str(order % 24), None,
                     "prior", json.dumps(products)))
    return raw_frame(spark, rows)


def test_published_averages(spark):
    raw = golden_raw(spark)
    fo, fp = build_fact_orders(raw), build_fact_order_products(raw)
    assert Q.total_orders(fo).first()[0] == 200
    assert Q.total_product_line_items(fp).first()[0] == 2405
    assert Q.average_basket_size(fp).first()[0] == 12.02    # 12.025, half-even
    assert Q.product_reorder_rate(fp).first()[0] == 61.12   # 1470 / 2405


def test_empty_tables_do_not_divide_by_zero(spark):
    raw = raw_frame(spark, [("1", "1", "1", "0", "7", None, "prior", "[]")])
    fp = build_fact_order_products(raw)
    assert Q.product_reorder_rate(fp).first()[0] is None
    assert Q.average_basket_size(fp).first()[0] is None
