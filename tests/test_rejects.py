"""The reject channel: values that a load does not take over as written."""

from __future__ import annotations

import os
import tempfile

import pytest

from cartwheel.operators.facts import MissingColumnsError
from cartwheel.operators.rejects import rejected_values
from cartwheel.sources import snapshots, warehouse
from cartwheel.streaming.ingest import ingest
from conftest import raw_frame

ROWS = [
    ("1", "1", "1", "0", "7", "2", "prior", '[{"product_id":"abc","add_to_cart_order":1.5,"reordered":true}]'),
    ("x", "1", "1", "0", "7", None, "prior", '[{"product_id":1},{"product_id":2}]'),
    (None, " ", "1", "0", "7", None, "prior", "[]"),
    ("4", "1", "one", "", "7", "1d", "prior", "not json"),
    ("5", "1", "1", "0", "7", None, "prior", '[null,7,[1],"t",{"product_id":" ","reordered":null}]'),
    ("6", "1", "1", "0", "7", None, "prior", ""),
    ("7", "1", "1", "0", "7", None, "prior", None),
    ("8", None, "1", "0", "7", None, "prior", '{"product_id":3}'),
]
WANT = sorted([
    ("product", "product_id", 0, "abc", "not a number"),
    ("product", "add_to_cart_order", 0, "1.5", "not a number"),
    ("order", "order_id", None, "x", "not a number"),
    ("product", "order_id", 0, None, "missing key"),
    ("product", "order_id", 1, None, "missing key"),
    ("order", "order_id", None, None, "missing key"),
    ("order", "user_id", None, " ", "missing key"),
    ("order", "order_number", None, "one", "not a number"),
    ("order", "days_since_prior_order", None, "1d", "not a number"),
    ("products", "products", None, "not json", "not a list"),
    ("product", "products", 0, "null", "not an object"),
    ("product", "products", 1, "7", "not an object"),
    ("product", "products", 2, "[1]", "not an object"),
    ("product", "products", 3, "t", "not an object"),
    ("order", "user_id", None, None, "missing key"),
    ("products", "products", None, '{"product_id":3}', "not a list"),
], key=repr)


def listed(df):
    return sorted((tuple(r) for r in df.select("entity", "column_name", "list_position", "value", "reason").collect()), key=repr)


def test_every_reason(spark):
    assert listed(rejected_values(raw_frame(spark, ROWS).repartition(3))) == WANT


def test_frames_without_products_rows_or_required_columns(spark):
    raw = raw_frame(spark, ROWS)
    assert listed(rejected_values(raw.drop("products"))) == [w for w in WANT if w[0] == "order"]
    assert listed(rejected_values(raw.limit(0))) == []
    assert listed(rejected_values(raw.withColumn("pos", raw.order_id).withColumn("item", raw.user_id))) == WANT
    with pytest.raises(MissingColumnsError):
        rejected_values(raw.drop("user_id"))


def test_rejects_are_published_with_the_facts(spark):
    root = tempfile.mkdtemp(prefix="cartwheel-rejects-")
    landing, wh = os.path.join(root, "landing"), os.path.join(root, "wh")
    warehouse.create_tables(spark, wh)
    raw_frame(spark, ROWS).coalesce(1).write.parquet(landing)
    stats = ingest(spark, landing, wh)
    assert (stats["rejected_values"], stats["coercion_failures"], stats["unparsed_product_cells"]) == (len(WANT), 3, 2)
    rejects = warehouse.rejected(spark, wh)
    assert listed(rejects) == WANT
    assert {r.row_index for r in rejects.where("column_name = 'product_id'").collect()} == {0}
    assert rejects.where("loaded_at is null or batch_id is null").isEmpty()
    assert {b.table for b in snapshots.current(spark, wh).batches} == {
        "fact_orders", "fact_order_products", "_rejected_values", "_loaded_files"}
    ingest(spark, landing, wh)
    assert warehouse.rejected(spark, wh).count() == len(WANT)


def test_a_clean_load_has_no_rejects(spark):
    root = tempfile.mkdtemp(prefix="cartwheel-rejects-")
    landing, wh = os.path.join(root, "landing"), os.path.join(root, "wh")
    warehouse.create_tables(spark, wh)
    raw_frame(spark, ROWS[5:7]).coalesce(1).write.parquet(landing)
    stats = ingest(spark, landing, wh)
    assert stats["orders_loaded"] == 2 and "rejected_values" not in stats
    assert warehouse.rejected(spark, wh).isEmpty()


def test_many_small_reject_batches_are_merged(spark):
    root = tempfile.mkdtemp(prefix="cartwheel-rejects-")
    landing, wh = os.path.join(root, "landing"), os.path.join(root, "wh")
    warehouse.create_tables(spark, wh)
    for _ in range(3):
        raw_frame(spark, ROWS[:1]).coalesce(1).write.mode("append").parquet(landing)
    ingest(spark, landing, wh, max_files_per_batch=1)
    before = listed(warehouse.rejected(spark, wh))
    assert len(before) == 6
    assert warehouse.compact(spark, wh, fewest=2)["_rejected_values"] == 3
    assert listed(warehouse.rejected(spark, wh)) == before


def test_rejects_are_found_in_generated_code(spark):
    """A lambda over the rejects (array_compact) had every element of every list interpreted."""
    plan = rejected_values(raw_frame(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in plan
    assert plan.count("parseJson") == 1      # once for the cell's own reject and its elements


def test_every_element_of_a_row_in_which_all_is_wrong(spark):
    bad = '[{"product_id":"p","add_to_cart_order":"c","reordered":0.5},null,{"product_id":1},"x"]'
    rows = [("z", " ", "a", "b", "c", "d", "prior", bad)]
    numbers = [("order", c, None, v, "not a number") for c, v in zip(
        ("order_id", "order_number", "order_dow", "order_hour_of_day", "days_since_prior_order"), "zabcd")]
    fields = [("product", c, 0, v, "not a number") for c, v in zip(("product_id", "add_to_cart_order", "reordered"), ("p", "c", "0.5"))]
    assert listed(rejected_values(raw_frame(spark, rows))) == sorted([
        *numbers, *fields, ("order", "user_id", None, " ", "missing key"),
        ("product", "order_id", 0, None, "missing key"), ("product", "order_id", 2, None, "missing key"),
        ("product", "products", 1, "null", "not an object"), ("product", "products", 3, "x", "not an object")], key=repr)
