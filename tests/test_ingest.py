import json
import os
import tempfile

import pytest

from cartwheel.plans.quality import LoadValidationError, validate_load
from cartwheel.sources import warehouse
from cartwheel.sources.landing import land_payloads
from cartwheel.streaming.ingest import ingest, load_batch, with_provenance, LANDING_SCHEMA


def order(oid, user=1, products=None, dow=1, hour=9):
    return {"order_id": oid, "user_id": user, "order_number": 1, "order_dow": dow,
            "order_hour_of_day": hour, "days_since_prior_order": None, "eval_set": "prior",
            "products": products or []}


def payload_dir(docs):
    d = tempfile.mkdtemp(prefix="cartwheel-payloads-")
    for name, records in docs.items():
        with open(os.path.join(d, name), "w") as f:
            json.dump(records, f)
    return d


@pytest.fixture()
def env(spark):
    root = tempfile.mkdtemp(prefix="cartwheel-ingest-")
    paths = {k: os.path.join(root, k) for k in ("payloads", "landing", "wh", "ckpt", "archive")}
    warehouse.create_tables(spark, paths["wh"])
    return paths


def test_two_files_then_nothing_new(spark, env):
    src = payload_dir({
        "a.json": [order(1, products=[{"product_id": 1, "add_to_cart_order": 1}]),
                   order(1, user=2), order(2)],
        "b.json": {"data": [order(3, products=[{"product_id": 5, "add_to_cart_order": 1},
                                               {"product_id": 5, "add_to_cart_order": 1}])]},
    })
    assert land_payloads(spark, src, env["landing"]) == 4
    landed_files = [f for f in os.listdir(env["landing"]) if f.endswith(".parquet")]
    stats = ingest(spark, env["landing"], env["wh"], env["ckpt"])
    assert stats == {"files_processed": len(landed_files),
                     "orders_loaded": 3, "products_loaded": 2, "unparsed_product_cells": 0, "coercion_failures": 0,
                     "total_orders_in_db": 3, "total_products_in_db": 2}
    fo = warehouse.read_table(spark, env["wh"], "fact_orders")
    assert {(r.order_id, r.user_id) for r in fo.collect()} == {(1, 1), (2, 1), (3, 1)}
    again = ingest(spark, env["landing"], env["wh"], env["ckpt"])
    assert again == {"files_processed": 0, "orders_loaded": 0, "products_loaded": 0,
                     "unparsed_product_cells": 0, "coercion_failures": 0}
    report = validate_load(fo, warehouse.read_table(spark, env["wh"], "fact_order_products"))
    assert report.orders_count == 3


def test_duplicates_across_files_are_kept_and_fail_the_gate(spark, env):
    land_payloads(spark, payload_dir({"a.json": [order(1)]}), env["landing"])
    ingest(spark, env["landing"], env["wh"], env["ckpt"])
    land_payloads(spark, payload_dir({"b.json": [order(1)]}), env["landing"])
    stats = ingest(spark, env["landing"], env["wh"], env["ckpt"])
    assert stats["total_orders_in_db"] == 2
    fo = warehouse.read_table(spark, env["wh"], "fact_orders")
    fp = warehouse.read_table(spark, env["wh"], "fact_order_products")
    with pytest.raises(LoadValidationError, match="duplicate"):
        validate_load(fo, fp)


def test_replayed_batch_is_idempotent(spark, env):
    land_payloads(spark, payload_dir({"a.json": [order(1, products=[{"product_id": 1}]), order(2)]}),
                  env["landing"])
    raw = with_provenance(spark.read.schema(LANDING_SCHEMA).parquet(env["landing"]))
    for _ in range(3):   # the same batch id written three times (retries)
        load_batch(raw, env["wh"], batch_id=0)
    assert warehouse.read_table(spark, env["wh"], "fact_orders").count() == 2
    assert warehouse.read_table(spark, env["wh"], "fact_order_products").count() == 1


def test_failed_batch_leaves_no_partial_rows_after_retry(spark, env):
    land_payloads(spark, payload_dir({"a.json": [order(1), order(2)]}), env["landing"])
    raw = with_provenance(spark.read.schema(LANDING_SCHEMA).parquet(env["landing"]))
    # First attempt wrote orders, then "failed" before products.
    from cartwheel.operators.facts import build_fact_orders
    warehouse.write_batch(build_fact_orders(raw), env["wh"], "fact_orders", 0)
    load_batch(raw, env["wh"], batch_id=0)    # the retry
    assert warehouse.read_table(spark, env["wh"], "fact_orders").count() == 2


def test_plain_parquet_files_use_file_metadata(spark, env):
    os.makedirs(env["landing"])
    df = spark.createDataFrame(
        [("5", "1", "1", "0", "7", None, "prior", '[{"product_id":1}]'),
         ("5", "2", "1", "0", "7", None, "prior", '[{"product_id":2}]')],
        "order_id string, user_id string, order_number string, order_dow string, "
        "order_hour_of_day string, days_since_prior_order string, eval_set string, products string")
    df.coalesce(1).write.mode("append").parquet(env["landing"])
    ingest(spark, env["landing"], env["wh"], env["ckpt"])
    (row,) = warehouse.read_table(spark, env["wh"], "fact_orders").collect()
    assert row.user_id == 1     # first row of the file wins
    assert warehouse.read_table(spark, env["wh"], "fact_order_products").count() == 2


def test_default_checkpoint_and_archive(spark, env):
    land_payloads(spark, payload_dir({"a.json": [order(1)]}), env["landing"])
    stats = ingest(spark, env["landing"], env["wh"], archive_dir=env["archive"])
    assert stats["orders_loaded"] == 1


def test_missing_tables_fail_before_loading(spark):
    root = tempfile.mkdtemp(prefix="cartwheel-nowh-")
    with pytest.raises(warehouse.MissingTableError):
        ingest(spark, os.path.join(root, "landing"), os.path.join(root, "wh"))


def test_empty_landing(spark, env):
    os.makedirs(env["landing"])
    assert ingest(spark, env["landing"], env["wh"], env["ckpt"]) == {
        "files_processed": 0, "orders_loaded": 0, "products_loaded": 0,
        "unparsed_product_cells": 0, "coercion_failures": 0}


def test_describe_and_preview(spark, env):
    land_payloads(spark, payload_dir({"a.json": [order(i) for i in range(20, 0, -1)]}), env["landing"])
    ingest(spark, env["landing"], env["wh"], env["ckpt"])
    desc = {r.col_name: r.data_type for r in warehouse.describe(spark, env["wh"], "fact_orders").collect()}
    assert desc["order_id"] == "bigint" and desc["loaded_at"] == "timestamp"
    first = warehouse.preview(spark, env["wh"], "fact_orders", ordered=True)
    assert [r.order_id for r in first.collect()] == list(range(1, 11))
    bare = warehouse.preview(spark, env["wh"], "fact_orders")
    assert bare.count() == 10 and set(bare.columns) >= {"order_id", "loaded_at", "batch_id"}
    assert "TakeOrderedAndProject" not in bare._jdf.queryExecution().executedPlan().toString()


def test_daily_load_end_to_end(spark, env):
    from cartwheel.daily import run_daily_load
    src = payload_dir({"a.json": {"status": "ok", "data": [
        order(1, products=[{"product_id": 1, "add_to_cart_order": 1, "reordered": True}]),
        order(2, dow=6, hour=23)]}})
    out = run_daily_load(spark, src, env["landing"], env["wh"], env["ckpt"])
    assert out["rows_landed"] == 2 and out["orders_loaded"] == 2 and out["products_loaded"] == 1
    assert out["gate"]["orders_count"] == 2
    fp = warehouse.read_table(spark, env["wh"], "fact_order_products").collect()
    assert [r.reordered for r in fp] == [1]     # JSON true survives landing as 1
    bad = payload_dir({"b.json": [order(3, dow=9)]})
    with pytest.raises(LoadValidationError, match="order_dow"):
        run_daily_load(spark, bad, env["landing"], env["wh"], env["ckpt"])


def test_archive_follows_the_load_and_never_reprocesses(spark, env):
    def archived():
        return sum(f.endswith(".parquet") for _, _, fs in os.walk(env["archive"]) for f in fs)
    land_payloads(spark, payload_dir({"a.json": [order(1)]}), env["landing"])
    ingest(spark, env["landing"], env["wh"], env["ckpt"], archive_dir=env["archive"])
    assert archived() == 1                      # moved once its batch is published
    land_payloads(spark, payload_dir({"b.json": [order(2)]}), env["landing"])
    stats = ingest(spark, env["landing"], env["wh"], env["ckpt"], archive_dir=env["archive"])
    assert archived() == 2
    assert stats["orders_loaded"] == 1 and stats["total_orders_in_db"] == 2


def test_queries_on_warehouse_tables_and_views(spark, env):
    from cartwheel.plans.registry import run_on_facts
    land_payloads(spark, payload_dir({"a.json": [
        order(1, products=[{"product_id": 1, "product_name": "apple", "add_to_cart_order": 1}]),
        order(2, products=[{"product_id": 1, "product_name": "apple", "add_to_cart_order": 1},
                           {"product_id": 2, "product_name": "pear", "add_to_cart_order": 2}])]}),
        env["landing"])
    ingest(spark, env["landing"], env["wh"], env["ckpt"])
    fo = warehouse.read_table(spark, env["wh"], "fact_orders")
    fp = warehouse.read_table(spark, env["wh"], "fact_order_products")
    top = [tuple(r) for r in run_on_facts("top_purchased_products", fo, fp).collect()]
    assert top == [("apple", 2), ("pear", 1)]
    assert run_on_facts("average_basket_size", fo, fp).first()[0] == 1.5
    warehouse.register_views(spark, env["wh"])
    assert spark.sql("SELECT count(*) FROM fact_order_products").first()[0] == 3


def test_tmp_and_other_files_are_ignored(spark, env):
    land_payloads(spark, payload_dir({"a.json": [order(1)]}), env["landing"])
    real = [f for f in os.listdir(env["landing"]) if f.endswith(".parquet")][0]
    with open(os.path.join(env["landing"], real), "rb") as f:
        data = f.read()
    # An in-flight upload and a stray file: neither ends in .parquet.
    with open(os.path.join(env["landing"], "orders_20260101_000000.parquet.tmp"), "wb") as f:
        f.write(data)
    with open(os.path.join(env["landing"], "notes.txt"), "w") as f:
        f.write("not data")
    stats = ingest(spark, env["landing"], env["wh"], env["ckpt"])
    assert stats["files_processed"] == 1 and stats["orders_loaded"] == 1


def test_unparseable_product_cells_are_counted(spark, env):
    os.makedirs(env["landing"])
    df = spark.createDataFrame(
        [("1", "1", "1", "0", "7", None, "prior", '[{"product_id":1,"reordered":NaN}]'),
         ("2", "1", "1", "0", "7", None, "prior", "not json"),
         ("3", "1", "1", "0", "7", None, "prior", '{"product_id":3}'),
         ("4", "1", "1", "0", "7", None, "prior", ""),
         ("5", "1", "1", "0", "7", None, "prior", '[{"product_id":5}]')],
        "order_id string, user_id string, order_number string, order_dow string, "
        "order_hour_of_day string, days_since_prior_order string, eval_set string, products string")
    df.coalesce(1).write.parquet(env["landing"], mode="append")
    stats = ingest(spark, env["landing"], env["wh"], env["ckpt"])
    assert stats["orders_loaded"] == 5 and stats["products_loaded"] == 1
    assert stats["unparsed_product_cells"] == 3
    assert stats["coercion_failures"] == 0


def test_coercion_failures_are_counted(spark, env):
    os.makedirs(env["landing"])
    df = spark.createDataFrame(
        [("1", "1", "x", "0", "7.5", "NaN", "prior", ""),      # 'x', '7.5' and 'NaN' fail
         ("2", "1", "2", "", "7", None, "prior", ""),          # blank is missing, not a failure
         ("3", "1", "1e3", "0", "7", "3", "prior", "")],
        "order_id string, user_id string, order_number string, order_dow string, "
        "order_hour_of_day string, days_since_prior_order string, eval_set string, products string")
    df.coalesce(1).write.parquet(env["landing"], mode="append")
    stats = ingest(spark, env["landing"], env["wh"], env["ckpt"])
    assert stats["orders_loaded"] == 3 and stats["coercion_failures"] == 3


def test_daily_load_rerun_lands_and_loads_nothing_twice(spark, env):
    from cartwheel.daily import run_daily_load
    src = payload_dir({"a.json": [order(1), order(2)], "b.json": [order(3)]})
    first = run_daily_load(spark, src, env["landing"], env["wh"], env["ckpt"], env["archive"])
    assert first["rows_landed"] == 3 and first["orders_loaded"] == 3
    again = run_daily_load(spark, src, env["landing"], env["wh"], env["ckpt"], env["archive"])
    assert again["rows_landed"] == 0 and again["orders_loaded"] == 0
    assert again["gate"]["orders_count"] == 3       # the gate still passes
    with open(os.path.join(src, "c.json"), "w") as f:
        json.dump([order(4)], f)
    third = run_daily_load(spark, src, env["landing"], env["wh"], env["ckpt"], env["archive"])
    assert third["rows_landed"] == 1 and third["gate"]["orders_count"] == 4


def test_continuous_stream_picks_up_new_files(spark, env):
    from cartwheel.streaming import start_ingest_stream
    land_payloads(spark, payload_dir({"a.json": [order(1)]}), env["landing"])
    query = start_ingest_stream(spark, env["landing"], env["wh"], "1 second", env["ckpt"])
    try:
        query.processAllAvailable()
        land_payloads(spark, payload_dir({"b.json": [order(2), order(3)]}), env["landing"])
        query.processAllAvailable()
    finally:
        query.stop()
    assert warehouse.read_table(spark, env["wh"], "fact_orders").count() == 3
    # The batch-mode ingest continues from the same checkpoint: nothing new.
    assert ingest(spark, env["landing"], env["wh"], env["ckpt"])["files_processed"] == 0


def test_crash_between_writes_then_rerun_is_exact(spark, env, monkeypatch):
    land_payloads(spark, payload_dir({"a.json": [order(1, products=[{"product_id": 1}]),
                                                 order(2, products=[{"product_id": 2}])]}),
                  env["landing"])
    real_stage = warehouse.stage_batch
    calls = []

    def crashing_stage(df, root, name, batch_id):
        calls.append((name, batch_id))
        out = real_stage(df, root, name, batch_id)
        if name == warehouse.FACT_ORDERS_TABLE and len(calls) == 1:
            raise RuntimeError("executor lost after the orders write")
        return out

    monkeypatch.setattr(warehouse, "stage_batch", crashing_stage)
    with pytest.raises(RuntimeError, match="executor lost"):
        ingest(spark, env["landing"], env["wh"], env["ckpt"])
    # The orders of the crashed batch are on disk, but nobody sees them.
    assert warehouse.read_table(spark, env["wh"], "fact_orders").count() == 0
    assert warehouse.read_table(spark, env["wh"], "fact_order_products").count() == 0
    stats = ingest(spark, env["landing"], env["wh"], env["ckpt"])   # the rerun
    crashed = calls[0][1]
    assert calls[1:3] == [("fact_orders", crashed), ("fact_order_products", crashed)]   # the same batch again
    assert stats["orders_loaded"] == 2 and stats["total_orders_in_db"] == 2
    assert stats["total_products_in_db"] == 2
    assert warehouse.clean(spark, env["wh"]) == 1       # the crashed attempt's folder


def test_table_with_wrong_schema_fails_before_loading(spark, env):
    root = tempfile.mkdtemp(prefix="cartwheel-badwh-")
    wh = os.path.join(root, "wh")
    warehouse.create_tables(spark, wh)
    bad = spark.createDataFrame([("x", 1)], "order_id string, batch_id long")
    bad.write.mode("overwrite").partitionBy("batch_id").parquet(os.path.join(wh, "fact_orders"))
    with pytest.raises(warehouse.TableSchemaError, match="order_id"):
        ingest(spark, os.path.join(root, "landing"), wh)
