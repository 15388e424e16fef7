import json
import os
import tempfile

import pytest

from cartwheel.sources.landing import (
    PayloadError,
    envelope_records,
    land_payloads,
    read_payloads,
    record_columns,
    records_to_rows,
)


def write_payloads(docs: dict[str, str]) -> str:
    d = tempfile.mkdtemp(prefix="cartwheel-payloads-")
    for name, text in docs.items():
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    return d


ENVELOPES = [
    ('[{"order_id":1},{"order_id":2}]', ["1", "2"]),
    ('{"status":"ok","zdata":[{"order_id":3}],"adata":[{"order_id":9}]}', ["3"]),
    ('{"a":[],"b":[{"order_id":1}]}', []),
    ('{"order_id":4}', ["4"]),
]


@pytest.mark.parametrize("doc,expected", ENVELOPES)
def test_envelopes(spark, doc, expected):
    d = write_payloads({"p.json": doc})
    records = envelope_records(read_payloads(spark, d))
    columns = record_columns(records)
    rows = records_to_rows(records, columns).orderBy("row_index").collect()
    if expected:
        assert [r.order_id for r in rows] == expected
    else:
        assert rows == []


def test_scalar_payload_is_one_record(spark):
    d = write_payloads({"p.json": "5"})
    records = envelope_records(read_payloads(spark, d))
    rows = records_to_rows(records, record_columns(records)).collect()
    assert [r["0"] for r in rows] == ["5"]


def test_land_nested_as_json_and_union_of_keys(spark):
    doc = json.dumps({"data": [
        {"order_id": 1, "user_id": "7", "products": [{"product_id": 1, "product_name": "café"}]},
        {"order_id": 2, "eval_set": "prior"},
        {"order_id": 3, "products": None},
    ]}, ensure_ascii=False)
    src = write_payloads({"a.json": doc})
    landing = tempfile.mkdtemp(prefix="cartwheel-landing-")
    assert land_payloads(spark, src, landing) == 3
    rows = {r.order_id: r for r in spark.read.parquet(landing).collect()}
    assert set(spark.read.parquet(landing).columns) >= {
        "order_id", "user_id", "eval_set", "products", "source_file", "row_index"}
    assert json.loads(rows["1"].products) == [{"product_id": 1, "product_name": "café"}]
    assert rows["2"].products == "" and rows["3"].products == ""
    assert rows["2"].user_id is None and rows["1"].eval_set is None
    assert [rows[k].row_index for k in ("1", "2", "3")] == [0, 1, 2]


def test_unparseable_payload_fails_before_writing(spark):
    src = write_payloads({"a.json": "[{\"order_id\":1}", "b.json": "[]"})
    landing = os.path.join(tempfile.mkdtemp(prefix="cartwheel-landing-"), "out")
    with pytest.raises(PayloadError):
        land_payloads(spark, src, landing)
    assert not os.path.exists(landing)


def test_declared_columns_skip_inference(spark):
    from cartwheel.sources.landing import CONTRACT_COLUMNS
    doc = json.dumps([{"order_id": 1, "products": [{"product_id": 2}], "extra": "ignored"}])
    landing = tempfile.mkdtemp(prefix="cartwheel-landing-")
    assert land_payloads(spark, write_payloads({"a.json": doc}), landing, columns=CONTRACT_COLUMNS) == 1
    (row,) = spark.read.parquet(landing).collect()
    assert "extra" not in row.asDict() and row.user_id is None
    assert json.loads(row.products) == [{"product_id": 2}]


def test_json_lines_split_across_tasks_keep_file_order(spark):
    from cartwheel.operators.facts import build_fact_orders
    from cartwheel.sources.landing import CONTRACT_COLUMNS, read_record_lines
    d = tempfile.mkdtemp(prefix="cartwheel-lines-")
    pad = "x" * 400
    with open(os.path.join(d, "orders.jsonl"), "w") as f:
        for i in range(6000):
            # order ids repeat every 1000 lines: the first pass (user 0) must win
            f.write(json.dumps({"order_id": i % 1000, "user_id": i // 1000, "eval_set": pad}) + "\n")
            if i % 7 == 0:
                f.write("\n")                          # blank lines are skipped
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        assert read_record_lines(spark, d).rdd.getNumPartitions() > 3
        landing = tempfile.mkdtemp(prefix="cartwheel-landing-")
        assert land_payloads(spark, d, landing, columns=CONTRACT_COLUMNS, lines=True) == 6000
        raw = spark.read.parquet(landing)
        fo = build_fact_orders(raw)
        got = fo.groupBy("user_id").count().collect()
        assert [(r.user_id, r["count"]) for r in got] == [(0, 1000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_json_lines_reject_bad_line(spark):
    d = write_payloads({"a.jsonl": '{"order_id":1}\n{"order_id":\n'})
    with pytest.raises(PayloadError):
        land_payloads(spark, d, tempfile.mkdtemp(prefix="cartwheel-landing-"), lines=True)


def test_a_second_call_lands_only_what_is_new(spark):
    from cartwheel.sources.landing import new_payloads
    src = write_payloads({f"{i}.json": json.dumps([{"order_id": i}]) for i in range(3)})
    landing = tempfile.mkdtemp(prefix="cartwheel-landing-")
    assert land_payloads(spark, src, landing) == 3
    found = new_payloads(spark, src, landing, "*.json")
    assert "content" not in found._jdf.queryExecution().executedPlan().toString()   # names only, no payload is read
    assert found.count() == 0 and land_payloads(spark, src, landing) == 0
