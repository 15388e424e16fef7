"""Build ``fact_orders`` and ``fact_order_products`` from a raw order frame.

Semantics preserved from the contract:

* orders: keep the first row per ``order_id`` within one source file, coerce
  types, then drop rows whose ``order_id`` or ``user_id`` is NULL;
* products: flattened from the *raw* frame (not from the surviving orders,
  so an order dropped for a NULL ``user_id`` leaves orphan products), coerced,
  rows without ``order_id`` dropped, then the first row kept per
  ``(order_id, product_id, add_to_cart_order)`` within one source file.

"First" means: smallest source row (``row_block``, ``row_index`` when the
frame was read from files; a row position must identify one row of its
source file), then the position inside the ``products`` list. A frame without
row positions falls back to its remaining columns as the tie-break, which
is deterministic under any partitioning.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cartwheel.functions.coerce import to_double, to_long, to_text
from cartwheel.operators.dedup import keep_first
from cartwheel.operators.products import explode_products
from cartwheel.schemas import (
    FACT_ORDER_PRODUCTS,
    FACT_ORDER_PRODUCTS_COLUMNS,
    ORDER_COLUMNS,
    PRODUCT_KEY,
    PRODUCTS_COLUMN,
    ROW_BLOCK,
    ROW_INDEX,
    SOURCE_FILE,
    nullable,
)


class MissingColumnsError(RuntimeError):
    """A raw frame lacks columns the contract requires."""


def require_columns(df: DataFrame, required: list[str], what: str) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"required columns missing for {what}: {missing}")


def loaded_at_literal(loaded_at: datetime | None) -> Column:
    """One load stamp per batch, truncated to whole seconds."""
    if loaded_at is None:
        return F.date_trunc("second", F.current_timestamp())
    return F.lit(loaded_at.replace(microsecond=0)).cast("timestamp")


def _provenance(df: DataFrame) -> tuple[list[str], list[str]]:
    """(per-file key columns, row-rank columns) available on this frame."""
    keys = [SOURCE_FILE] if SOURCE_FILE in df.columns else []
    rank = [c for c in (ROW_BLOCK, ROW_INDEX) if c in df.columns]
    return keys, rank


def coerce_orders(raw: DataFrame) -> DataFrame:
    """The typed order columns beside file and row position; rows without an order id go here,
    which keeps the NULL group (the only unbounded key) out of the shuffle that follows."""
    require_columns(raw, ORDER_COLUMNS, "fact_orders")
    dtypes = {f.name: f.dataType for f in raw.schema.fields}
    file_keys, rank = _provenance(raw)
    coerced = raw.select(
        *file_keys, *rank,
        to_long(F.col("order_id"), dtypes["order_id"]).alias("order_id"),
        to_long(F.col("user_id"), dtypes["user_id"]).alias("user_id"),
        to_long(F.col("order_number"), dtypes["order_number"]).alias("order_number"),
        to_long(F.col("order_dow"), dtypes["order_dow"]).alias("order_dow"),
        to_long(F.col("order_hour_of_day"), dtypes["order_hour_of_day"]).alias("order_hour_of_day"),
        to_double(F.col("days_since_prior_order"), dtypes["days_since_prior_order"])
        .alias("days_since_prior_order"),
        to_text(F.col("eval_set"), dtypes["eval_set"]).alias("eval_set"),
    )
    return coerced.where(F.col("order_id").isNotNull())


def first_orders(coerced: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """``fact_orders`` from coerced rows: the first of each order and file, with a user."""
    file_keys, rank = _provenance(coerced)
    payload = [c for c in ORDER_COLUMNS if c != "order_id"]
    first = keep_first(coerced, [*file_keys, "order_id"], rank, payload)
    return (
        first.where(F.col("user_id").isNotNull())
        .select(*ORDER_COLUMNS, loaded_at_literal(loaded_at).alias("loaded_at"))
    )


def build_fact_orders(raw: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    return first_orders(coerce_orders(raw), loaded_at)


NUMERIC_ORDER_COLUMNS = [c for c in ORDER_COLUMNS if c != "eval_set"]


def coercion_failures(raw: DataFrame) -> Column:
    """Aggregate: order values that were present (not NULL, not blank) but
    did not coerce to a number — they load as NULL, and the load counts them."""
    dtypes = {f.name: f.dataType for f in raw.schema.fields}
    total = F.lit(0).cast("bigint")
    for c in NUMERIC_ORDER_COLUMNS:
        if c not in dtypes:
            continue
        present = F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != F.lit(""))
        coerced = (to_double if c == "days_since_prior_order" else to_long)(F.col(c), dtypes[c])
        total = total + F.count_if(present & coerced.isNull())
    return total


def empty_fact_order_products(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], nullable(FACT_ORDER_PRODUCTS))


def flatten_products(raw: DataFrame) -> DataFrame:
    """The typed product rows beside file, row and list position (a frame with a product column)."""
    require_columns(raw, ["order_id"], "fact_order_products")
    dtypes = {f.name: f.dataType for f in raw.schema.fields}
    file_keys, rank = _provenance(raw)
    carry = [F.col(c) for c in (*file_keys, *rank)]
    carry.append(to_long(F.col("order_id"), dtypes["order_id"]).alias("order_id"))
    return explode_products(raw, carry).where(F.col("order_id").isNotNull())


# Positions in a product list take 25 bits: a list is a VARIANT of at most 128 MiB, in which an
# element of a list that long takes five bytes (four of its offset, one of its value).
LIST_BITS = 25
ROW_BITS = 63 - LIST_BITS


def list_rank(row: Column, pos: Column) -> Column:
    """(row, list position) as one BIGINT of the same order; an error where it would not fit."""
    fits = (row >= 0) & (row < (1 << ROW_BITS)) & (pos < (1 << LIST_BITS))
    return F.when(fits, row * (1 << LIST_BITS) + pos).otherwise(
        F.raise_error(F.lit(f"row positions of {ROW_BITS} bits are needed to rank products")).cast("bigint"))


def first_products(rows: DataFrame, loaded_at: datetime | None = None) -> DataFrame:
    """``fact_order_products`` from flattened rows: the first of each product line and file.

    With a row position alone, row and list position become one rank, so that product columns
    a query does not use are not carried through the shuffle."""
    file_keys, rank = _provenance(rows)
    payload = [c for c in FACT_ORDER_PRODUCTS_COLUMNS if c not in (*PRODUCT_KEY, "loaded_at")]
    order = [*rank, "pos"]
    if rank == [ROW_INDEX]:
        rows = rows.withColumn("pos", list_rank(F.col(ROW_INDEX), F.col("pos")))
        order = ["pos"]
    first = keep_first(rows, [*file_keys, *PRODUCT_KEY], order, payload)
    return first.select(*FACT_ORDER_PRODUCTS_COLUMNS[:-1],
                        loaded_at_literal(loaded_at).alias("loaded_at"))


def build_fact_order_products(raw: DataFrame,
                              loaded_at: datetime | None = None) -> DataFrame:
    require_columns(raw, ["order_id"], "fact_order_products")
    if PRODUCTS_COLUMN not in raw.columns:
        return empty_fact_order_products(raw.sparkSession)
    return first_products(flatten_products(raw), loaded_at)
