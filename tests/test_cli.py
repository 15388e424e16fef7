import json
import os
import tempfile

from cartwheel.__main__ import main
from conftest import SF_SMALL


def test_list(capsys):
    assert main(["list"]) == 0
    names = capsys.readouterr().out.split()
    assert "basket_size_category" in names and "landed_fact_orders" in names


def test_query_on_test_tables(spark, capsys):
    assert main(["query", "total_orders", "--tables", SF_SMALL]) == 0
    assert "1500" in capsys.readouterr().out


def test_daily_then_validate_and_query_warehouse(spark, capsys):
    root = tempfile.mkdtemp(prefix="cartwheel-cli-")
    payloads = os.path.join(root, "payloads")
    os.makedirs(payloads)
    with open(os.path.join(payloads, "a.json"), "w") as f:
        json.dump({"data": [{"order_id": 1, "user_id": 2, "order_number": 1, "order_dow": 3,
                             "order_hour_of_day": 4, "days_since_prior_order": None,
                             "eval_set": "prior", "products": [{"product_id": 9,
                                                               "product_name": "fig"}]}]}, f)
    wh = os.path.join(root, "wh")
    args = ["daily", "--payloads", payloads, "--landing", os.path.join(root, "landing"),
            "--warehouse", wh, "--checkpoint", os.path.join(root, "ckpt"), "--buckets", "2"]
    assert main(args) == 0
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert stats["orders_loaded"] == 1 and stats["products_loaded"] == 1
    assert main(["validate", "--warehouse", wh]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["orders_count"] == 1
    assert main(["query", "top_purchased_products", "--warehouse", wh]) == 0
    assert "fig" in capsys.readouterr().out


def test_daily_with_json_lines(spark, capsys):
    root = tempfile.mkdtemp(prefix="cartwheel-cli-lines-")
    payloads = os.path.join(root, "payloads")
    os.makedirs(payloads)
    with open(os.path.join(payloads, "orders.jsonl"), "w") as f:
        for oid in (1, 2, 2):      # order 2 twice in one file: the first line wins
            f.write(json.dumps({"order_id": oid, "user_id": 7, "order_number": oid,
                                "order_dow": 1, "order_hour_of_day": 9,
                                "days_since_prior_order": None, "eval_set": "prior",
                                "products": [{"product_id": oid}]}) + "\n")
    args = ["daily", "--lines", "--payloads", payloads,
            "--landing", os.path.join(root, "landing"), "--warehouse", os.path.join(root, "wh"),
            "--checkpoint", os.path.join(root, "ckpt")]
    assert main(args) == 0
    stats = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert stats["rows_landed"] == 3
    assert stats["orders_loaded"] == 2 and stats["products_loaded"] == 2
    assert stats["gate"]["duplicate_orders"] == 0
