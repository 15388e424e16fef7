"""Reshape the TPC-H-style test tables into the raw order contract.

``orders`` + ``lineitem`` + ``part`` become raw orders whose line items are a
JSON list in the ``products`` column, exactly what the order source delivers:

=====================  ==============================================================
raw column             derived from
=====================  ==============================================================
order_id, user_id      ``o_orderkey``, ``o_custkey``
order_number           position of the order among the customer's orders,
                       ordered by ``(o_orderdate, o_orderkey)``, from 1
order_dow              day of week of ``o_orderdate``, 0 = Sunday
order_hour_of_day      ``o_orderkey % 24`` (order dates carry no time of day)
days_since_prior_order days since the customer's previous order (double)
eval_set               ``o_orderstatus``: F → prior, O → train, P → test
products               JSON list of ``lineitem ⋈ part`` per order, ``''`` if none
=====================  ==============================================================

Product object: product_id = l_partkey, product_name = p_name, aisle = p_type,
department = p_brand, add_to_cart_order = l_linenumber, reordered = R → 1,
A → 0, N → key omitted. The list is ordered by
``(l_linenumber, l_partkey, reordered or -1)`` so "keep first" is defined.

Scale notes. The customer sequence is computed in two levels so that no
window ever holds one customer's whole history: per (customer, day) counts
are pre-aggregated map-side, the running count over days runs on that
aggregate (at most one row per calendar day per customer), and the final
rank runs within one customer-day. The per-order JSON list is a basket
(bounded by the order, not by the data), built reduce-side after one
shuffle on the order key. The ``part`` join is left to the planner: AQE
broadcasts it only when its measured size is under the broadcast threshold,
and sort-merges otherwise.
"""

from __future__ import annotations

import os
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cartwheel.operators.facts import build_fact_order_products, build_fact_orders
from cartwheel.schemas import ROW_INDEX, SOURCE_FILE
from cartwheel.session import checkpoint_dir

# --- Fixed values: the mapping from test-table codes to contract values. ---
EVAL_SET_BY_STATUS = {"F": "prior", "O": "train", "P": "test"}
REORDERED_BY_RETURNFLAG = {"R": 1, "A": 0}
# --- end of fixed values ---

FIXTURE_LOADED_AT = datetime(2026, 1, 1, 0, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _code_map(col, mapping: dict):
    expr = None
    for code, value in mapping.items():
        expr = F.when(col == code, F.lit(value)) if expr is None else expr.when(col == code, F.lit(value))
    return expr


def customer_sequence(o: DataFrame) -> DataFrame:
    """Add order_number and days_since_prior_order to ``o``.

    ``o`` has order_id, user_id, day and any other per-order columns, which
    are carried through untouched.
    """
    extra = [c for c in o.columns if c not in ("order_id", "user_id", "day")]
    per_day = o.groupBy("user_id", "day").agg(F.count(F.lit(1)).alias("n"))
    by_day = Window.partitionBy("user_id").orderBy("day")
    per_day = per_day.select(
        "user_id", "day",
        F.coalesce(F.sum("n").over(by_day.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("before"),
        F.lag("day").over(by_day).alias("prev_day"),
    )
    within_day = Window.partitionBy("user_id", "day").orderBy("order_id")
    ranked = o.withColumn("rank_in_day", F.row_number().over(within_day))
    # Left join: every order finds its (customer, day) row; a query that does
    # not use the sequence columns lets Catalyst drop the join altogether.
    joined = ranked.join(per_day, ["user_id", "day"], "left")
    return joined.select(
        "order_id", "user_id", *extra,
        (F.col("before") + F.col("rank_in_day")).cast("bigint").alias("order_number"),
        F.when(F.col("rank_in_day") > 1, F.lit(0.0))
        .otherwise(F.datediff("day", "prev_day").cast("double"))
        .alias("days_since_prior_order"),
    )


def products_json(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """order_id, products (JSON list text) for every order that has lines."""
    lines = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag").join(
        part.select("p_partkey", "p_name", "p_type", "p_brand"),
        F.col("l_partkey") == F.col("p_partkey"), "inner")
    reordered = _code_map(F.col("l_returnflag"), REORDERED_BY_RETURNFLAG)
    # Field order is the list order: structs compare field by field and NULL
    # sorts first, so the native sort_array orders by (l_linenumber,
    # l_partkey, reordered with NULL as lowest) with no lambda comparator.
    # JSON object key order carries no meaning for the consumer.
    item = F.struct(
        F.col("l_linenumber").alias("add_to_cart_order"),
        F.col("l_partkey").alias("product_id"),
        reordered.alias("reordered"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("aisle"),
        F.col("p_brand").alias("department"),
    )
    # Shuffle the lines by order first: a partial collect_list saves no bytes
    # (a basket is a handful of lines), so the list is built once, reduce-side,
    # in parallel tasks; the aggregate then needs no second exchange.
    per_order = (
        lines.repartition("l_orderkey")
        .groupBy(F.col("l_orderkey").alias("order_id"))
        .agg(F.sort_array(F.collect_list(item)).alias("items"))
    )
    return per_order.select("order_id", F.to_json("items").alias("products"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders (contract columns, ``products`` as JSON text) from the test tables."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.to_date("o_orderdate").alias("day"),
        (F.dayofweek("o_orderdate") - 1).cast("bigint").alias("order_dow"),
        (F.col("o_orderkey") % 24).cast("bigint").alias("order_hour_of_day"),
        _code_map(F.col("o_orderstatus"), EVAL_SET_BY_STATUS).alias("eval_set"),
    )
    seq = customer_sequence(orders)
    lines = products_json(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"))
    raw = (
        seq.join(lines, "order_id", "left")
        .select(
            "order_id", "user_id", "order_number", "order_dow", "order_hour_of_day",
            "days_since_prior_order", "eval_set",
            F.coalesce(F.col("products"), F.lit("")).alias("products"),
            # The synthetic source lists its orders by key: that is the row
            # position "keep first" ranks by.
            F.col("order_id").alias(ROW_INDEX),
        )
    )
    return raw


def fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact_orders(raw_orders(spark, sf_dir), FIXTURE_LOADED_AT)


def fact_order_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact_order_products(raw_orders(spark, sf_dir), FIXTURE_LOADED_AT)


def delivered_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders as two deliveries of text, dirty by rule: an order whose id is
    divisible by ``n`` has

    ==  ===================================  ==  ===================================
     3  its hour written with ``.0``         31  a blank user (its products are orphans)
     7  day of week 9                        37  no order number
    11  a second delivery                    41  a products cell cut short
    13  a second row, of user 0, after it    43  a first product at cart place 0
    17  day of week ``x``                    47  products without names
    19  hour 24                              53  a gap of ``1d``
    23  order number 0                       29  a gap of -1
    ==  ===================================  ==  ===================================

    Where two rules meet on a column, the larger ``n`` wins.
    """
    raw = raw_orders(spark, sf_dir)
    key = F.col("order_id")

    def dirty(value, rules: dict):
        out = None
        for n, other in sorted(rules.items(), reverse=True):
            out = F.when(key % n == 0, other) if out is None else out.when(key % n == 0, other)
        return out.otherwise(value)

    def row(day: str, nth: int):
        return F.struct(F.lit(day).alias("day"), F.lit(nth).alias("nth"))
    rows = raw.withColumn("row", F.explode(F.array_compact(F.array(
        row("day-1", 0), F.when(key % 13 == 0, row("day-1", 1)), F.when(key % 11 == 0, row("day-2", 0))))))
    hour = F.col("order_hour_of_day").cast("string")
    products = F.col("products")
    return rows.select(
        key.cast("string").alias("order_id"),
        F.when(F.col("row.nth") == 1, "0").otherwise(dirty(F.col("user_id").cast("string"), {31: F.lit(" ")})).alias("user_id"),
        dirty(F.col("order_number").cast("string"), {23: F.lit("0"), 37: F.lit(None).cast("string")}).alias("order_number"),
        dirty(F.col("order_dow").cast("string"), {7: F.lit("9"), 17: F.lit("x")}).alias("order_dow"),
        dirty(hour, {3: F.concat(hour, F.lit(".0")), 19: F.lit("24")}).alias("order_hour_of_day"),
        dirty(F.col("days_since_prior_order").cast("string"), {29: F.lit("-1"), 53: F.lit("1d")}).alias("days_since_prior_order"),
        "eval_set",
        dirty(products, {41: F.lit('[{"product_id":'), 47: F.replace(products, F.lit('"product_name"'), F.lit('"name"')),
                         43: F.replace(products, F.lit('{"add_to_cart_order":1,'), F.lit('{"add_to_cart_order":0,'))}).alias("products"),
        F.col("row.day").alias(SOURCE_FILE),
        (F.col(ROW_INDEX) * 2 + F.col("row.nth")).alias(ROW_INDEX),
    )


def mixed_folder(spark: SparkSession, sf_dir: str) -> str:
    """A folder of raw-order files of three schemas, dealt by the order id: text columns,
    typed columns, and typed columns without products. Returns its path, in the shared folder."""
    raw = raw_orders(spark, sf_dir).drop(ROW_INDEX)
    path = os.path.join(checkpoint_dir(spark), "cartwheel-mixed", uuid.uuid4().hex)
    third = F.col("order_id") % 3
    for part in (raw.where(third == 0).select(*[F.col(c).cast("string") for c in raw.columns]),
                 raw.where(third == 1), raw.where(third == 2).drop("products")):
        part.write.mode("append").parquet(path)
    return path


def payload_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders as API payloads: one JSON document per order,
    ``{"status": "ok", "data": [order]}``, with ``products`` a nested list.

    source_file, text — the shape ``landing.read_payloads`` produces from
    payload files, so the envelope and landing steps run on table data.
    """
    raw = raw_orders(spark, sf_dir)
    record = F.struct(
        *[F.col(c) for c in raw.columns if c not in ("products", ROW_INDEX)],
        F.try_parse_json(F.col("products")).alias("products"),
    )
    doc = F.struct(F.lit("ok").alias("status"), F.array(record).alias("data"))
    return raw.select(
        F.concat(F.lit("order-"), F.col("order_id").cast("string"), F.lit(".json")).alias("source_file"),
        F.to_json(doc).alias("text"),
    )


def landed_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payload documents pushed through envelope normalisation and landing
    projection: raw orders with every column as landed text."""
    from cartwheel.sources.landing import CONTRACT_COLUMNS, envelope_records, records_to_rows
    docs = payload_documents(spark, sf_dir)
    payloads = docs.select("source_file", "text", F.try_parse_json("text").alias("payload"))
    records = envelope_records(payloads)
    # The order contract is known, so the landing schema is declared rather
    # than inferred (inference, ``record_columns``, costs one more pass).
    return records_to_rows(records, CONTRACT_COLUMNS)
