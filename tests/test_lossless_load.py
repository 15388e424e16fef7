"""Loads that must never touch each other's rows, nor load a file twice."""

import os

import pytest

from cartwheel.sources import warehouse
from cartwheel.streaming.ingest import ingest

COLUMNS = ("order_id string, user_id string, order_number string, order_dow string, order_hour_of_day string, "
           "days_since_prior_order string, eval_set string, products string")


def land(spark, folder, *ids):
    rows = [(str(i), "7", "1", "0", "7", None, "prior", '[{"product_id": 1, "add_to_cart_order": 1}]') for i in ids]
    spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(str(folder))


def ids(spark, wh):
    return sorted(r.order_id for r in warehouse.read_table(spark, wh, "fact_orders").collect())


@pytest.fixture()
def wh(spark, tmp_path):
    path = str(tmp_path / "wh")
    warehouse.create_tables(spark, path)
    return path


def test_two_folders_into_one_warehouse(spark, tmp_path, wh):
    land(spark, tmp_path / "a", 1, 2)
    land(spark, tmp_path / "b", 3)
    for name in ("a", "b"):
        ingest(spark, str(tmp_path / name), wh, str(tmp_path / f"ckpt-{name}"))
    assert ids(spark, wh) == [1, 2, 3]
    assert warehouse.read_table(spark, wh, "fact_order_products").count() == 3


def test_a_fresh_checkpoint_loads_only_what_is_new(spark, tmp_path, wh):
    land(spark, tmp_path / "a", 1, 2, 3)
    ingest(spark, str(tmp_path / "a"), wh, str(tmp_path / "one"))
    land(spark, tmp_path / "a", 4)
    ingest(spark, str(tmp_path / "a"), wh, str(tmp_path / "two"))
    assert ids(spark, wh) == [1, 2, 3, 4]


def test_a_fresh_checkpoint_beside_an_archive(spark, tmp_path, wh):
    for n, key in enumerate((1, 2, 3)):
        land(spark, tmp_path / "a", key)
        ingest(spark, str(tmp_path / "a"), wh, str(tmp_path / "one"), archive_dir=str(tmp_path / "old"))
    land(spark, tmp_path / "a", 4)
    ingest(spark, str(tmp_path / "a"), wh, str(tmp_path / "two"), archive_dir=str(tmp_path / "old"))
    assert ids(spark, wh) == [1, 2, 3, 4]


def test_describe_needs_the_table(spark, tmp_path):
    with pytest.raises(warehouse.MissingTableError):
        warehouse.describe(spark, str(tmp_path / "none"), "fact_orders")
    assert not os.path.exists(tmp_path / "none")
