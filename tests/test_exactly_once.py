"""Landing and loading exactly once: mixed schemas, re-delivery, crashes at any point, batch
sizes, several writers, and compaction."""

import json
import os

import pytest

from cartwheel.operators.facts import MissingColumnsError
from cartwheel.sources import landing, snapshots, storage, warehouse
from cartwheel.sources.landing import finish_landings, land_payloads
from cartwheel.streaming.ingest import form_batches, ingest, pending_units

ORDER = ("order_id string, user_id string, order_number string, order_dow string, order_hour_of_day string, "
         "days_since_prior_order string, eval_set string")


@pytest.fixture()
def env(spark, tmp_path):
    paths = {k: str(tmp_path / k) for k in ("payloads", "landing", "wh", "archive")}
    os.makedirs(paths["payloads"])
    warehouse.create_tables(spark, paths["wh"])
    return paths


def put(env, name, ids, user=1, pad=0, lines=False):
    records = [{"order_id": i, "user_id": user, "order_number": 1, "order_dow": 1, "order_hour_of_day": 9, "days_since_prior_order": None,
                "eval_set": "prior" + "x" * pad, "products": [{"product_id": i, "add_to_cart_order": 1}]} for i in ids]
    with open(os.path.join(env["payloads"], name), "w") as f:
        f.write("\n".join(map(json.dumps, records)) if lines else json.dumps(records))


def orders(spark, env):
    return sorted((r.order_id, r.user_id) for r in warehouse.read_table(spark, env["wh"], "fact_orders").collect())


def products(spark, env):
    return warehouse.read_table(spark, env["wh"], "fact_order_products").count()


def loose(spark, env, rows, schema, times=1):
    for _ in range(times):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(env["landing"])


ROW = ("1", "1", "0", "7", None, "prior")


def test_files_of_several_schemas(spark, env):
    """The first has no products; the others type their columns differently."""
    loose(spark, env, [("1", *ROW)], ORDER)
    loose(spark, env, [("2", *ROW, '[{"product_id": 1}]')], ORDER + ", products string")
    loose(spark, env, [(3, 1, 1, 0, 7, 2.0, "prior", [(5, "fig")], "extra")],
          "order_id long, user_id int, order_number short, order_dow long, order_hour_of_day long, days_since_prior_order double, "
          "eval_set string, products array<struct<product_id:long,product_name:string>>, more string")
    stats = ingest(spark, env["landing"], env["wh"])
    assert stats["files_processed"] == 3 and stats["orders_loaded"] == 3 and stats["products_loaded"] == 2
    assert [o for o, _ in orders(spark, env)] == [1, 2, 3]
    gap = {r.order_id: r.days_since_prior_order for r in warehouse.read_table(spark, env["wh"], "fact_orders").collect()}
    assert gap == {1: None, 2: None, 3: 2.0}


@pytest.mark.parametrize("first", [True, False])
def test_a_file_without_a_required_column_is_named(spark, env, first):
    short = ORDER.replace("user_id string, ", "")
    files = [([("1", *ROW)], ORDER), ([("2", *ROW[1:])], short)]
    for rows, schema in files if first else files[::-1]:
        loose(spark, env, rows, schema)
    lacking = [f.path for unit in pending_units(spark, env["landing"], env["wh"]) for f in unit
               if "user_id" not in spark.read.parquet(f.path).columns]
    with pytest.raises(MissingColumnsError, match="user_id") as error:
        ingest(spark, env["landing"], env["wh"])
    assert len(lacking) == 1 and lacking[0] in str(error.value) and "1 of 2 files" in str(error.value)
    assert orders(spark, env) == []


def test_unreadable_schemes_fall_back_to_sparks_reader(spark, env, monkeypatch):
    from importlib import import_module
    loose(spark, env, [("1", *ROW)], ORDER)
    monkeypatch.setattr(import_module("cartwheel.streaming.ingest"), "_SPARK_SCHEMA", None)   # the task cannot tell
    (unit,) = pending_units(spark, env["landing"], env["wh"])
    schemas = import_module("cartwheel.streaming.ingest").footer_schemas(spark, [unit[0].path])
    assert set(schemas[unit[0].path].fieldNames()) >= {"order_id", "user_id"}


def test_a_redelivered_name_lands_again(spark, env):
    put(env, "a.json", [1, 2])
    assert land_payloads(spark, env["payloads"], env["landing"]) == 2
    put(env, "a.json", [1, 3, 4], user=9)
    assert land_payloads(spark, env["payloads"], env["landing"]) == 3
    assert land_payloads(spark, env["payloads"], env["landing"]) == 0
    ingest(spark, env["landing"], env["wh"])
    # Two deliveries are two scopes, also when they are loaded together.
    assert orders(spark, env) == [(1, 1), (1, 9), (2, 1), (3, 9), (4, 9)]


@pytest.mark.parametrize("step", ["write_new", "finish_landings", "rename_new"])
def test_a_landing_that_dies_anywhere(spark, env, monkeypatch, step):
    put(env, "a.json", range(5))
    put(env, "b.json", range(5, 9))
    calls = []

    def dying(*args, real=getattr(storage, step, None)):
        calls.append(args)
        if step == "rename_new" and len(calls) == 1:
            return real(*args)              # the commit itself goes through, the move of a file dies
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if step == "finish_landings":
            real_finish = landing.finish_landings
            m.setattr(landing, step, lambda *a: dying(*a) if landing.committed(spark, env["landing"]) else real_finish(*a))
        else:
            m.setattr(storage, step, dying)
        with pytest.raises(RuntimeError, match="lost"):
            land_payloads(spark, env["payloads"], env["landing"])
    done = bool(landing.committed(spark, env["landing"]))
    assert done == (step != "write_new")
    assert pending_units(spark, env["landing"], env["wh"]) == []     # no part of a landing is admitted
    assert land_payloads(spark, env["payloads"], env["landing"]) == (0 if done else 9)
    assert ingest(spark, env["landing"], env["wh"])["orders_loaded"] == 9
    assert land_payloads(spark, env["payloads"], env["landing"]) == 0
    assert ingest(spark, env["landing"], env["wh"])["files_processed"] == 0


def test_ingest_finishes_a_landing(spark, env, monkeypatch):
    put(env, "a.json", range(3))
    with monkeypatch.context() as m:
        m.setattr(landing, "finish_landings", lambda *a: 0)
        land_payloads(spark, env["payloads"], env["landing"])
    assert not [f for f in os.listdir(env["landing"]) if f.endswith(".parquet")]
    assert ingest(spark, env["landing"], env["wh"])["orders_loaded"] == 3


def test_a_half_arrived_landing_waits(spark, env):
    put(env, "orders.jsonl", [*range(300)] * 2, pad=50, lines=True)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert land_payloads(spark, env["payloads"], env["landing"], lines=True) == 600
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    files = sorted(f for f in os.listdir(env["landing"]) if f.endswith(".parquet"))
    assert len(files) > 3
    away = os.path.join(env["payloads"], files[1])
    os.rename(os.path.join(env["landing"], files[1]), away)
    assert ingest(spark, env["landing"], env["wh"])["files_processed"] == 0
    os.rename(away, os.path.join(env["landing"], files[1]))
    # One payload in many files is one scope, whatever the batch size.
    stats = ingest(spark, env["landing"], env["wh"], max_files_per_batch=1)
    assert stats["files_processed"] == len(files) and len(orders(spark, env)) == 300 and products(spark, env) == 300


@pytest.mark.parametrize("size", [None, 1, 2])
def test_batch_size_changes_no_result(spark, env, size):
    for n in range(3):
        put(env, f"{n}.json", [n, n, n + 1, 50], user=n)
        land_payloads(spark, env["payloads"], env["landing"])
    loose(spark, env, [("50", "7", *ROW[1:]), ("50", "8", *ROW[1:])], ORDER, times=2)
    stats = ingest(spark, env["landing"], env["wh"], max_files_per_batch=size, archive_dir=env["archive"])
    want = [(n + d, n) for n in range(3) for d in (0, 1)] + [(50, n) for n in range(3)] + [(50, 7)] * 2
    assert orders(spark, env) == sorted(want) and products(spark, env) == 9
    assert stats["files_processed"] == len(os.listdir(env["archive"])) - sum(f.startswith(".") for f in os.listdir(env["archive"]))
    assert ingest(spark, env["landing"], env["wh"])["files_processed"] == 0


def test_units_are_never_cut():
    units = [[1, 2, 3], [4], [5], [6, 7]]
    assert form_batches(units, None) == [[1, 2, 3, 4, 5, 6, 7]]
    assert form_batches(units, 2) == [[1, 2, 3], [4, 5], [6, 7]]
    assert form_batches([], 2) == []


@pytest.mark.parametrize("dies_at", range(5))       # after each of the four staged tables, and after the swap
def test_a_load_that_dies_anywhere_loads_once(spark, env, monkeypatch, dies_at):
    put(env, "a.json", range(4))
    land_payloads(spark, env["payloads"], env["landing"])
    real_stage, real_publish, calls = warehouse.stage_batch, snapshots.publish, []
    with monkeypatch.context() as m:
        def stage(*args):
            out = real_stage(*args)
            calls.append(out)
            if len(calls) - 1 == dies_at:
                raise RuntimeError("lost")
            return out

        def publish(*args):
            real_publish(*args)
            raise RuntimeError("lost")          # right after the swap

        m.setattr(warehouse, "stage_batch", stage)
        m.setattr(snapshots, "publish", publish)
        with pytest.raises(RuntimeError, match="lost"):
            ingest(spark, env["landing"], env["wh"])
    visible = 4 if dies_at == 4 else 0
    assert len(orders(spark, env)) == products(spark, env) == visible
    ingest(spark, env["landing"], env["wh"])
    ingest(spark, env["landing"], env["wh"], str(dies_at))              # a fresh checkpoint changes nothing
    assert len(orders(spark, env)) == products(spark, env) == 4


def test_of_two_loads_at_once_one_starts_over(spark, env, monkeypatch):
    put(env, "a.json", range(4))
    land_payloads(spark, env["payloads"], env["landing"])
    real, raced = snapshots.publish, []

    def publish(*args):
        if not raced:
            raced.append(1)
            ingest(spark, env["landing"], env["wh"])                    # the other load, all of it
        return real(*args)

    monkeypatch.setattr(snapshots, "publish", publish)
    assert ingest(spark, env["landing"], env["wh"])["files_processed"] == 0
    assert len(orders(spark, env)) == products(spark, env) == 4


def test_a_snapshot_stays_readable_while_others_load(spark, env):
    put(env, "a.json", range(4))
    land_payloads(spark, env["payloads"], env["landing"])
    ingest(spark, env["landing"], env["wh"])
    held = snapshots.current(spark, env["wh"])
    put(env, "b.json", range(10, 13))
    land_payloads(spark, env["payloads"], env["landing"])
    ingest(spark, env["landing"], env["wh"])
    old = [warehouse.read_table(spark, env["wh"], t, held).count() for t in warehouse.TABLES]
    assert old == [4, 4] and len(orders(spark, env)) == 7


@pytest.mark.parametrize("buckets", [None, 2])
def test_compaction_bounds_the_files(spark, tmp_path, buckets):
    env = {k: str(tmp_path / k) for k in ("payloads", "landing", "wh")}
    warehouse.create_tables(spark, env["wh"], buckets=buckets)
    for n in range(8):
        loose(spark, env, [(str(n), *ROW, '[{"product_id": 1}]'), (str(100 + n), *ROW, "")], ORDER + ", products string")
        ingest(spark, env["landing"], env["wh"])
    before = orders(spark, env)
    held = snapshots.current(spark, env["wh"])
    assert len(held.of("fact_orders")) == 8
    assert warehouse.compact(spark, env["wh"]) == dict.fromkeys([*warehouse.TABLES, warehouse.LOADED_TABLE], 8)
    after = snapshots.current(spark, env["wh"])
    assert [len(after.of(t)) for t in (*warehouse.TABLES, warehouse.LOADED_TABLE)] == [1, 1, 1]
    assert sum(b.files for b in after.of("fact_orders")) <= (buckets or 1)
    assert orders(spark, env) == before and products(spark, env) == 8
    if not buckets:
        assert warehouse.read_table(spark, env["wh"], "fact_orders", held).count() == 16    # readers of the last snapshot go on
    assert warehouse.compact(spark, env["wh"]) == {}
    assert ingest(spark, env["landing"], env["wh"])["files_processed"] == 0                   # the notes are merged, not lost


def test_compaction_deals_ranges_of_order_ids(spark, env):
    from cartwheel.operators.facts import build_fact_orders
    for n in range(4):
        raw = spark.range(n, 4000, 4).selectExpr("id order_id", "1 user_id", "1 order_number", "0 order_dow", "7 order_hour_of_day",
                                                 "null days_since_prior_order", "uuid() eval_set")
        warehouse.write_batch(build_fact_orders(raw).repartition(2), env["wh"], "fact_orders", n)
    size = sum(b.bytes for b in snapshots.current(spark, env["wh"]).of("fact_orders"))
    assert warehouse.compact(spark, env["wh"], target_bytes=size // 3, fewest=4) == {"fact_orders": 4}
    table = warehouse.read_table(spark, env["wh"], "fact_orders")
    spans = sorted(tuple(r) for r in table.selectExpr("order_id", "_metadata.file_path f").groupBy("f")
                   .agg({"order_id": "min"}).join(table.selectExpr("order_id o", "_metadata.file_path f").groupBy("f").agg({"o": "max"}), "f")
                   .drop("f").collect())
    assert 3 <= len(spans) <= 4 and table.count() == 4000
    assert all(high < low for (_, high), (low, _) in zip(spans, spans[1:]))       # no two files overlap
