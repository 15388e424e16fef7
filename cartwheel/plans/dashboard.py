"""The dashboard queries, as DataFrame plans over the two fact tables.

Every function takes the fact DataFrames and returns a small result
DataFrame; nothing is collected. Ties under ``ORDER BY … LIMIT`` get an
explicit tie-breaker so top-k results are deterministic.

Scale notes: every aggregate is a partial + final hash aggregate, so the
shuffle carries one row per group per map task. The only single-partition
step is the share-of-total window, which runs on the handful of label
groups after aggregation. Top-k uses ``orderBy().limit()``, which plans as
``TakeOrderedAndProject`` (per-task top-k, then a merge of k rows per task).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cartwheel.functions.labels import (
    DAY_NAMES,
    basket_size_category as basket_label,
    day_name,
    hour_label,
    reorder_interval,
    reorder_status,
)
from cartwheel.functions.numeric import pct_of, round2, share_of_total

def rows():
    """count(*) — every row, NULLs included."""
    return F.count(F.lit(1))


# ---------------------------------------------------------------- overview
def total_orders(fo: DataFrame) -> DataFrame:
    return fo.agg(rows().alias("total_orders"))


def total_product_line_items(fp: DataFrame) -> DataFrame:
    return fp.agg(rows().alias("total_product_line_items"))


def product_reorder_rate(fp: DataFrame) -> DataFrame:
    return fp.agg(pct_of(F.count_if(F.col("reordered") == 1), rows())
                  .alias("product_reorder_rate"))


def basket_sizes(fp: DataFrame) -> DataFrame:
    """order_id, total_products: product rows per order."""
    return fp.groupBy("order_id").agg(rows().alias("total_products"))


def average_basket_size(fp: DataFrame) -> DataFrame:
    return basket_sizes(fp).agg(round2(F.avg("total_products")).alias("average_basket_size"))


# ---------------------------------------------------------------- time patterns
def orders_by_day_of_week(fo: DataFrame) -> DataFrame:
    return (
        fo.groupBy("order_dow").agg(rows().alias("total_orders"))
        .orderBy("order_dow")
        .select(day_name(F.col("order_dow")).alias("day_name"), "total_orders")
    )


def orders_by_hour_of_day(fo: DataFrame) -> DataFrame:
    return (
        fo.groupBy(F.col("order_hour_of_day").alias("hour_of_day"))
        .agg(rows().alias("total_orders"))
        .orderBy("hour_of_day")
    )


def top_ordering_time_windows(fo: DataFrame, k: int = 5) -> DataFrame:
    return (
        fo.groupBy("order_dow", "order_hour_of_day").agg(rows().alias("total_orders"))
        .orderBy(F.desc("total_orders"), "order_dow", "order_hour_of_day")
        .limit(k)
        .select(day_name(F.col("order_dow")).alias("day_name"),
                hour_label(F.col("order_hour_of_day")).alias("hour_of_day"),
                "total_orders")
    )


# ---------------------------------------------------------------- reorder behaviour
def reorder_interval_distribution(fo: DataFrame) -> DataFrame:
    return (
        fo.groupBy(reorder_interval(F.col("days_since_prior_order")).alias("reorder_interval"))
        .agg(rows().alias("total_orders"))
        .select("reorder_interval", "total_orders",
                share_of_total(F.col("total_orders")).alias("percentage"))
        .orderBy(F.desc("total_orders"), "reorder_interval")
    )


def product_reorder_status(fp: DataFrame) -> DataFrame:
    return (
        fp.groupBy(reorder_status(F.col("reordered")).alias("reorder_status"))
        .agg(rows().alias("total_product_line_items"))
        .select("reorder_status", "total_product_line_items",
                share_of_total(F.col("total_product_line_items")).alias("percentage"))
        .orderBy(F.desc("total_product_line_items"), "reorder_status")
    )


# ---------------------------------------------------------------- basket sizes
def basket_size_category(fp: DataFrame) -> DataFrame:
    return (
        basket_sizes(fp)
        .groupBy(basket_label(F.col("total_products")).alias("basket_size_category"))
        .agg(rows().alias("total_orders"))
        .select("basket_size_category", "total_orders",
                share_of_total(F.col("total_orders")).alias("percentage"))
        .orderBy(F.desc("total_orders"), "basket_size_category")
    )


def largest_basket_orders(fo: DataFrame, fp: DataFrame, k: int = 10) -> DataFrame:
    """Orders with the most products: ``fact_orders ⟕ fact_order_products``.

    Rewritten as aggregate-below-join: with ``m`` identical order rows per
    group and ``c`` non-null product ids per order_id, join-then-count gives
    ``m * c``. Both sides shrink to one row per order before the join, so the
    join never fans out, however many products an order has. The counts are one
    row per order too, so they are merged and never broadcast: the planner takes
    a parsed list for about 200 times smaller than it is (a VARIANT counts as 2 kB
    before its fields are read) and would send all orders through the driver.
    """
    keys = ["order_id", "user_id", "order_number", "order_dow", "order_hour_of_day"]
    orders = fo.groupBy(*keys).agg(rows().alias("m"))
    counts = fp.groupBy("order_id").agg(F.count("product_id").alias("c"))
    joined = orders.join(counts.hint("merge"), "order_id", "left")
    total = (F.col("m") * F.coalesce(F.col("c"), F.lit(0))).alias("total_products")
    return (
        joined.select(*keys, total)
        .orderBy(F.desc("total_products"), "order_id", "user_id", "order_number",
                 "order_dow", "order_hour_of_day")
        .limit(k)
        .select("order_id", "user_id", "order_number",
                day_name(F.col("order_dow")).alias("day_name"),
                hour_label(F.col("order_hour_of_day")).alias("hour_of_day"),
                "total_products")
    )


# ---------------------------------------------------------------- products
def top_purchased_products(fp: DataFrame, k: int = 10) -> DataFrame:
    return (
        fp.groupBy("product_name").agg(rows().alias("total_purchased"))
        .orderBy(F.desc("total_purchased"), "product_name")
        .limit(k)
    )


def products_by_department(fp: DataFrame) -> DataFrame:
    return (
        fp.groupBy("department").agg(rows().alias("total_products"))
        .orderBy(F.desc("total_products"), "department")
    )


def product_reorder_opportunity(fp: DataFrame, k: int = 10) -> DataFrame:
    """Our definition (the dashboard names this section without a query):
    the k most purchased products with their reorder count and rate."""
    return (
        fp.groupBy("product_name")
        .agg(rows().alias("total_purchased"),
             F.count_if(F.col("reordered") == 1).alias("total_reordered"))
        .select("product_name", "total_purchased", "total_reordered",
                pct_of(F.col("total_reordered"), F.col("total_purchased")).alias("reorder_rate"))
        .orderBy(F.desc("total_purchased"), "product_name")
        .limit(k)
    )


def day_hour_matrix(fo: DataFrame) -> DataFrame:
    """Orders per day of week × hour of day, one row per day, one column per hour.

    ``hour_other`` counts orders without an hour or with one outside 0-23, so
    a row sums to the day's orders. Conditional counts: one grouping.
    """
    hour = F.col("order_hour_of_day")
    cells = [F.count_if(hour == h).alias(f"hour_{h}") for h in range(24)]
    other = F.count_if(hour.isNull() | ~hour.between(0, 23)).alias("hour_other")
    return (
        fo.groupBy("order_dow").agg(*cells, other)
        .select("order_dow", day_name(F.col("order_dow")).alias("day_name"), *[f"hour_{h}" for h in range(24)], "hour_other")
        .orderBy("order_dow")
    )


__all__ = [
    "total_orders", "total_product_line_items", "product_reorder_rate",
    "basket_sizes", "average_basket_size", "orders_by_day_of_week", "orders_by_hour_of_day",
    "top_ordering_time_windows", "reorder_interval_distribution", "product_reorder_status",
    "basket_size_category", "largest_basket_orders", "top_purchased_products",
    "products_by_department", "product_reorder_opportunity", "day_hour_matrix",
]
