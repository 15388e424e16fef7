"""The gate from a snapshot's totals equals the gate that counts whole tables."""

import json
import random

import pytest

from cartwheel.plans import quality
from cartwheel.plans.quality import LoadReport, LoadValidationError
from cartwheel.sources import gate, snapshots, warehouse
from cartwheel.streaming.ingest import ingest, load_batch
from conftest import raw_frame


@pytest.fixture()
def wh(spark, tmp_path):
    root = str(tmp_path / "wh")
    warehouse.create_tables(spark, root)
    return root


def raw(spark, orders):
    """``(id, day, hour)`` of each order, with as many products as its id's last digit."""
    return raw_frame(spark, [(str(i), "1", "1", str(d), str(h), None, "prior", json.dumps(
        [{"product_id": p, "add_to_cart_order": p + 1} for p in range(i % 10)])) for i, d, h in orders])


def counted(spark, root):
    snapshot = snapshots.current(spark, root)
    return quality.load_report(*[warehouse.read_table(spark, root, t, snapshot) for t in warehouse.TABLES])


def load(spark, root, orders):
    return load_batch(raw(spark, orders), root, snapshots.current(spark, root).next_batch())


def no_scan(monkeypatch):
    def scan(*_):
        raise AssertionError("tables are read")
    monkeypatch.setattr(gate, "load_report", scan)


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_whole_count_on_random_loads(spark, wh, seed, monkeypatch):
    rng = random.Random(seed)
    for turn in range(5):
        start = rng.randrange(60)
        load(spark, wh, [(rng.randrange(start, start + 30), rng.choice([0, 6, 7, -1]), rng.choice([0, 23, 24]))
                         for _ in range(rng.randrange(1, 25))])
        if turn == 3:
            assert warehouse.compact(spark, wh, fewest=2)
    want = counted(spark, wh)
    assert want.duplicate_orders and want.invalid_order_dow and want.invalid_order_hour
    no_scan(monkeypatch)
    assert gate.warehouse_report(spark, wh) == want


def test_higher_ids_meet_no_stored_batch(spark, wh):
    load(spark, wh, [(i, 1, 1) for i in range(1, 10)])
    load(spark, wh, [(i, 1, 1) for i in range(20, 30)])
    base = snapshots.current(spark, wh)
    assert [(b.low, b.high) for b in base.of("fact_orders")] == [(1, 9), (20, 29)]
    new = snapshots.Batch("fact_orders", 9, "x", 1, 1, 1, 30, 40)
    assert gate.meeting(base, new) == []
    assert [b.low for b in gate.meeting(base, snapshots.Batch("fact_orders", 9, "x", 1, 1, 1, 9, 19))] == [1]


def test_an_order_stored_often_counts_once(spark, wh):
    for _ in range(3):
        load(spark, wh, [(5, 1, 1), (6, 1, 1)])
    assert gate.warehouse_report(spark, wh) == LoadReport(6, 33, 4, 0, 0)
    with pytest.raises(LoadValidationError, match="duplicate order_id rows: 4"):
        gate.validate_warehouse(spark, wh)


def test_empty_warehouse_and_empty_load(spark, wh):
    with pytest.raises(LoadValidationError, match="empty"):
        gate.validate_warehouse(spark, wh)
    load(spark, wh, [])
    load(spark, wh, [(3, 1, 1)])
    assert gate.validate_warehouse(spark, wh) == LoadReport(1, 3, 0, 0, 0)


def test_a_batch_written_again_is_counted_once_and_known_then(spark, wh, monkeypatch):
    load(spark, wh, [(1, 1, 1), (2, 1, 1)])
    load(spark, wh, [(2, 1, 1), (3, 9, 1)])
    load_batch(raw(spark, [(3, 1, 1)]), wh, 0)
    assert snapshots.current(spark, wh).totals is None
    assert gate.warehouse_report(spark, wh) == counted(spark, wh) == LoadReport(3, 8, 1, 1, 0)
    no_scan(monkeypatch)
    assert gate.warehouse_report(spark, wh) == LoadReport(3, 8, 1, 1, 0)
    load(spark, wh, [(3, 1, 1), (4, 1, 1)])
    assert gate.warehouse_report(spark, wh) == counted(spark, wh) == LoadReport(5, 15, 2, 1, 0)


def test_recount_finds_totals_that_are_wrong(spark, wh):
    load(spark, wh, [(1, 1, 1)])
    assert gate.warehouse_report(spark, wh, recount=True) == LoadReport(1, 1, 0, 0, 0)
    base = snapshots.current(spark, wh)
    snapshots.publish(spark, wh, base, [], frozenset(), snapshots.Totals(2, 2, 0, 0))
    with pytest.raises(gate.TotalsError, match="notes"):
        gate.warehouse_report(spark, wh, recount=True)


def test_snapshot_without_totals_or_bounds(spark, wh):
    """One written before there were totals: counted once; its batches may hold any id."""
    load(spark, wh, [(1, 1, 1), (2, 1, 1)])
    path = f"{wh}/{snapshots.FOLDER}/1.json"
    with open(path) as f:
        content = json.load(f)
    del content["totals"]
    content["batches"] = [{k: v for k, v in b.items() if k not in ("low", "high")} for b in content["batches"]]
    snapshots.storage.write_new(spark, f"{wh}/{snapshots.FOLDER}/2.json", {**content, "version": 2})
    assert gate.warehouse_report(spark, wh) == LoadReport(2, 3, 0, 0, 0)
    load(spark, wh, [(2, 1, 1), (4, 1, 1)])
    assert snapshots.current(spark, wh).totals == snapshots.Totals(4, 3, 0, 0)


def test_bucketed_warehouse_and_ingest(spark, tmp_path, monkeypatch):
    root, landing = str(tmp_path / "b"), str(tmp_path / "landing")
    warehouse.create_tables(spark, root, buckets=2)
    for ids in ([11, 12, 13], [13, 14]):
        raw(spark, [(i, 1, 1) for i in ids]).coalesce(1).write.mode("append").parquet(landing)
    stats = ingest(spark, landing, root, max_files_per_batch=1)
    assert (stats["total_orders_in_db"], stats["total_products_in_db"]) == (5, 13)
    want = counted(spark, root)
    no_scan(monkeypatch)
    assert gate.warehouse_report(spark, root) == want == LoadReport(5, 13, 1, 0, 0)
