"""Every named query as ``(spark, sf_dir) -> DataFrame`` over the test tables.

Each callable reshapes the test tables into raw orders, builds the fact
tables with the ingest operators and runs one query; all of it is one lazy
plan, so Catalyst prunes what a query does not need (an order-only query
never parses a product list).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cartwheel.operators.facts import (
    build_fact_order_products,
    build_fact_orders,
    coerce_orders,
    first_orders,
    first_products,
    flatten_products,
)
from cartwheel.plans import dashboard as Q
from cartwheel.plans import quality as D
from cartwheel.sources import fixtures, storage
from cartwheel.streaming.ingest import scan_files

QueryFn = Callable[[SparkSession, str], DataFrame]


# Which fact tables each query reads: "o" orders, "p" products, "op" both.
FACT_QUERIES: dict[str, tuple[str, Callable[..., DataFrame]]] = {
    "total_orders": ("o", Q.total_orders),
    "total_product_line_items": ("p", Q.total_product_line_items),
    "product_reorder_rate": ("p", Q.product_reorder_rate),
    "average_basket_size": ("p", Q.average_basket_size),
    "orders_by_day_of_week": ("o", Q.orders_by_day_of_week),
    "orders_by_hour_of_day": ("o", Q.orders_by_hour_of_day),
    "top_ordering_time_windows": ("o", Q.top_ordering_time_windows),
    "reorder_interval_distribution": ("o", Q.reorder_interval_distribution),
    "product_reorder_status": ("p", Q.product_reorder_status),
    "basket_size_category": ("p", Q.basket_size_category),
    "largest_basket_orders": ("op", Q.largest_basket_orders),
    "top_purchased_products": ("p", Q.top_purchased_products),
    "products_by_department": ("p", Q.products_by_department),
    "product_reorder_opportunity": ("p", Q.product_reorder_opportunity),
    "day_hour_matrix": ("o", Q.day_hour_matrix),
    "dq_order_duplicates": ("o", D.dq_order_duplicates),
    "dq_order_nulls": ("o", D.dq_order_nulls),
    "dq_order_ranges": ("o", D.dq_order_ranges),
    "dq_eval_set_distribution": ("o", D.dq_eval_set_distribution),
    "dq_product_rows": ("p", D.dq_product_rows),
    "dq_average_basket": ("p", D.dq_average_basket),
    "dq_orphan_products": ("op", D.dq_orphan_products),
    "dq_product_line_consistency": ("p", D.dq_product_line_consistency),
    "validate_load": ("op", D.load_metrics),
}


def run_on_facts(name: str, fo: DataFrame | None, fp: DataFrame | None) -> DataFrame:
    """Run a named dashboard / quality query on given fact DataFrames
    (e.g. the warehouse tables)."""
    needs, fn = FACT_QUERIES[name]
    args = {"o": (fo,), "p": (fp,), "op": (fo, fp)}[needs]
    return fn(*args)


def _from_tables(name: str) -> QueryFn:
    needs, _ = FACT_QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = fixtures.raw_orders(spark, sf_dir)
        fo = build_fact_orders(raw, fixtures.FIXTURE_LOADED_AT) if "o" in needs else None
        fp = build_fact_order_products(raw, fixtures.FIXTURE_LOADED_AT) if "p" in needs else None
        return run_on_facts(name, fo, fp)
    run.__name__ = name
    return run


def fact_orders_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flattened order fact table itself (load stamp left out)."""
    return fixtures.fact_orders(spark, sf_dir).drop("loaded_at")


def fact_order_products_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flattened product fact table itself (load stamp left out)."""
    return fixtures.fact_order_products(spark, sf_dir).drop("loaded_at")


def landed_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_orders built from the tables by way of JSON payloads and landing."""
    raw = fixtures.landed_raw_orders(spark, sf_dir)
    return build_fact_orders(raw, fixtures.FIXTURE_LOADED_AT).drop("loaded_at")


def landed_fact_order_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_order_products built by way of JSON payloads and landing."""
    raw = fixtures.landed_raw_orders(spark, sf_dir)
    return build_fact_order_products(raw, fixtures.FIXTURE_LOADED_AT).drop("loaded_at")


def dq_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-order quality over the raw orders reshaped from the test tables."""
    return D.dq_raw_orders(fixtures.raw_orders(spark, sf_dir))


# Checks that clean tables cannot trigger, on deliveries that are dirty by rule.
DIRTY = ["dq_order_duplicates", "dq_order_nulls", "dq_order_ranges", "dq_product_rows", "dq_orphan_products",
         "dq_product_line_consistency", "validate_load", "reorder_interval_distribution"]


def _from_deliveries(name: str) -> QueryFn:
    needs, _ = FACT_QUERIES[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = fixtures.delivered_raw_orders(spark, sf_dir)
        fo = build_fact_orders(raw, fixtures.FIXTURE_LOADED_AT) if "o" in needs else None
        fp = build_fact_order_products(raw, fixtures.FIXTURE_LOADED_AT) if "p" in needs else None
        return run_on_facts(name, fo, fp)
    run.__name__ = f"dirty_{name}"
    return run


def dirty_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_orders of the dirty deliveries: coerced, the first row of each order and delivery."""
    return build_fact_orders(fixtures.delivered_raw_orders(spark, sf_dir), fixtures.FIXTURE_LOADED_AT).drop("loaded_at")


def dirty_fact_order_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_order_products of the dirty deliveries."""
    return build_fact_order_products(fixtures.delivered_raw_orders(spark, sf_dir), fixtures.FIXTURE_LOADED_AT).drop("loaded_at")


def dirty_rejected_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of the dirty deliveries that a load would not take over, by entity, column and reason."""
    return D.dq_rejected_values(fixtures.delivered_raw_orders(spark, sf_dir))


def dirty_dq_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-order quality of the dirty deliveries."""
    return D.dq_raw_orders(fixtures.delivered_raw_orders(spark, sf_dir))


def mixed_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_orders from a folder of files of three schemas, scanned by schema group."""
    raws = _mixed(spark, sf_dir)
    return first_orders(reduce(DataFrame.unionByName, map(coerce_orders, raws)), fixtures.FIXTURE_LOADED_AT).drop("loaded_at")


def mixed_fact_order_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_order_products from the same folder; one kind of file has no products."""
    raws = [flatten_products(raw) for raw in _mixed(spark, sf_dir) if "products" in raw.columns]
    return first_products(reduce(DataFrame.unionByName, raws), fixtures.FIXTURE_LOADED_AT).drop("loaded_at")


def _mixed(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    files = storage.listing(spark, fixtures.mixed_folder(spark, sf_dir), "*.parquet").select("path").collect()
    return scan_files(spark, [f.path for f in files])


QUERIES: dict[str, QueryFn] = {
    **{name: _from_tables(name) for name in FACT_QUERIES},
    "dq_raw_orders": dq_raw_orders,
    # the ingest output itself
    "fact_orders": fact_orders_rows,
    "fact_order_products": fact_order_products_rows,
    # the same facts by way of payload envelopes and landing (text columns)
    "landed_fact_orders": landed_fact_orders,
    "landed_fact_order_products": landed_fact_order_products,
    # dirty deliveries, and files of several schemas
    **{f"dirty_{name}": _from_deliveries(name) for name in DIRTY},
    "dirty_fact_orders": dirty_fact_orders,
    "dirty_fact_order_products": dirty_fact_order_products,
    "dirty_dq_raw_orders": dirty_dq_raw_orders,
    "dirty_rejected_values": dirty_rejected_values,
    "mixed_fact_orders": mixed_fact_orders,
    "mixed_fact_order_products": mixed_fact_order_products,
}
