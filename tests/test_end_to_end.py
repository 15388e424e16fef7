"""Landing files → streaming ingest → warehouse tables → every named query,
compared with the same queries computed in one plan from the test tables."""

import os
import tempfile

import pytest

from cartwheel.plans.registry import FACT_QUERIES, QUERIES, run_on_facts
from cartwheel.sources import fixtures, warehouse
from cartwheel.streaming.ingest import ingest
from conftest import SF_SMALL


@pytest.fixture(scope="module", params=[None, 4], ids=["plain", "bucketed"])
def loaded(spark, request):
    root = tempfile.mkdtemp(prefix="cartwheel-e2e-")
    landing, wh = os.path.join(root, "landing"), os.path.join(root, "wh")
    # Raw orders land as three Parquet files (the source's typed columns).
    fixtures.raw_orders(spark, SF_SMALL).repartition(3, "order_id").write.parquet(landing)
    warehouse.create_tables(spark, wh, buckets=request.param)
    stats = ingest(spark, landing, wh, os.path.join(root, "ckpt"), max_files_per_batch=2)
    fo = warehouse.read_table(spark, wh, warehouse.FACT_ORDERS_TABLE)
    fp = warehouse.read_table(spark, wh, warehouse.FACT_ORDER_PRODUCTS_TABLE)
    return stats, fo, fp, request.param


def test_load_statistics(loaded):
    stats = loaded[0]
    assert stats["files_processed"] == 3
    assert stats["orders_loaded"] == stats["total_orders_in_db"] == 1500
    assert stats["products_loaded"] == stats["total_products_in_db"] == 5996


@pytest.mark.parametrize("name", sorted(FACT_QUERIES))
def test_warehouse_query_matches_in_memory_plan(spark, loaded, name):
    _, fo, fp, _ = loaded
    got = sorted(tuple(r) for r in run_on_facts(name, fo, fp).collect())
    want = sorted(tuple(r) for r in QUERIES[name](spark, SF_SMALL).collect())
    assert got == want


def test_bucketed_tables_join_without_shuffle(spark, loaded):
    _, fo, fp, buckets = loaded
    if not buckets:
        pytest.skip("plain layout")
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = run_on_facts("largest_basket_orders", fo, fp)._jdf.queryExecution() \
            .executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)
    below_topk = plan[plan.index("TakeOrderedAndProject"):]
    assert "SortMergeJoin" in below_topk
    assert "Exchange" not in below_topk      # both sides read bucket by bucket
    assert "Bucketed: true" in plan


@pytest.mark.parametrize("buckets", [None, 3])
def test_batch_replay_overwrites_only_its_partition(spark, buckets):
    from cartwheel.operators.facts import build_fact_orders
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"
    wh = os.path.join(tempfile.mkdtemp(prefix="cartwheel-replay-"), "wh")
    warehouse.create_tables(spark, wh, buckets=buckets)
    fo = build_fact_orders(fixtures.raw_orders(spark, SF_SMALL))
    warehouse.write_batch(fo.where("order_id % 2 = 0"), wh, "fact_orders", 0)
    for _ in range(2):      # batch 1 written, then replayed
        warehouse.write_batch(fo.where("order_id % 2 = 1"), wh, "fact_orders", 1)
    table = warehouse.read_table(spark, wh, "fact_orders")
    assert table.count() == 1500
    assert sorted(r["count"] for r in table.groupBy("batch_id").count().collect()) == [750, 750]


@pytest.mark.parametrize("buckets", [None, 3])
def test_replay_with_empty_output_leaves_no_stale_rows(spark, buckets):
    from cartwheel.operators.facts import build_fact_orders
    wh = os.path.join(tempfile.mkdtemp(prefix="cartwheel-empty-"), "wh")
    warehouse.create_tables(spark, wh, buckets=buckets)
    fo = build_fact_orders(fixtures.raw_orders(spark, SF_SMALL))
    warehouse.write_batch(fo, wh, "fact_orders", 0)
    warehouse.write_batch(fo, wh, "fact_orders", 1)
    warehouse.write_batch(fo.where("false"), wh, "fact_orders", 1)   # replay, now empty
    table = warehouse.read_table(spark, wh, "fact_orders")
    assert [r["count"] for r in table.groupBy("batch_id").count().collect()] == [1500]
