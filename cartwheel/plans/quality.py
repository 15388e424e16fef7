"""Data-quality checks over the fact tables and the load gate.

Each check is one global (or small grouped) aggregate: a single scan and a
single job, with partial aggregation map-side.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cartwheel.functions.numeric import round2
from cartwheel.plans.dashboard import basket_sizes, rows


def dq_order_duplicates(fo: DataFrame) -> DataFrame:
    return fo.agg(
        rows().alias("total_rows"),
        F.count_distinct("order_id").alias("unique_orders"),
        (rows() - F.count_distinct("order_id")).alias("duplicate_orders"),
    )


def dq_order_nulls(fo: DataFrame) -> DataFrame:
    return fo.agg(
        F.count_if(F.col("order_id").isNull()).alias("null_order_id"),
        F.count_if(F.col("user_id").isNull()).alias("null_user_id"),
        F.count_if(F.col("order_number").isNull()).alias("null_order_number"),
        F.count_if(F.col("order_dow").isNull()).alias("null_order_dow"),
        F.count_if(F.col("order_hour_of_day").isNull()).alias("null_order_hour"),
    )


def bad_dow():
    return (F.col("order_dow") < 0) | (F.col("order_dow") > 6)


def bad_hour():
    return (F.col("order_hour_of_day") < 0) | (F.col("order_hour_of_day") > 23)


def dq_order_ranges(fo: DataFrame) -> DataFrame:
    return fo.agg(
        F.count_if(bad_dow()).alias("invalid_order_dow"),
        F.count_if(bad_hour()).alias("invalid_order_hour"),
        F.count_if(F.col("order_number") < 1).alias("invalid_order_number"),
        F.count_if(F.col("days_since_prior_order") < 0).alias("invalid_days_since_prior_order"),
    )


def dq_eval_set_distribution(fo: DataFrame) -> DataFrame:
    return (fo.groupBy("eval_set").agg(rows().alias("total_orders"))
            .orderBy(F.desc("total_orders"), "eval_set"))


def dq_product_rows(fp: DataFrame) -> DataFrame:
    return fp.agg(
        rows().alias("total_product_rows"),
        F.count_if(F.col("order_id").isNull()).alias("null_order_id"),
        F.count_if(F.col("product_name") == "").alias("empty_product_name"),
        F.count_if(F.col("add_to_cart_order") < 1).alias("invalid_add_to_cart_order"),
    )


def dq_average_basket(fp: DataFrame) -> DataFrame:
    return basket_sizes(fp).agg(round2(F.avg("total_products")).alias("avg_products_per_order"))


def dq_raw_orders(raw: DataFrame) -> DataFrame:
    """Quality of a raw order frame (landing files, a source extract) before
    loading: rows, ``products`` cells that are not JSON lists (those orders
    yield no products), and order values that do not coerce (they load as
    NULL). One aggregate, one scan."""
    from cartwheel.operators.facts import coercion_failures
    from cartwheel.operators.products import unparsed_cell
    from cartwheel.schemas import PRODUCTS_COLUMN
    cells = (F.count_if(unparsed_cell(F.col(PRODUCTS_COLUMN), raw.schema[PRODUCTS_COLUMN].dataType))
             if PRODUCTS_COLUMN in raw.columns else F.lit(0).cast("bigint"))
    return raw.agg(
        rows().alias("raw_rows"),
        cells.alias("unparsed_product_cells"),
        coercion_failures(raw).alias("coercion_failures"),
    )


def dq_rejected_values(raw: DataFrame) -> DataFrame:
    """What loading a raw frame would not take over as written: counts by entity, column and reason."""
    from cartwheel.operators.rejects import rejected_values
    return rejected_values(raw).groupBy("entity", "column_name", "reason").agg(rows().alias("rejected"))


def dq_orphan_products(fo: DataFrame, fp: DataFrame) -> DataFrame:
    """Product rows whose order_id has no row in fact_orders.

    Products are first reduced to one row per order_id (partial aggregate,
    so a hot order costs one row per map task), then anti-joined with the
    distinct order ids, and the per-order counts summed.
    """
    per_order = fp.groupBy("order_id").agg(rows().alias("n"))
    known = fo.select("order_id").distinct()
    orphans = per_order.join(known, "order_id", "left_anti")
    return orphans.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphan_product_rows"),
        F.count(F.lit(1)).alias("orphan_orders"),
    )


def dq_product_line_consistency(fp: DataFrame) -> DataFrame:
    """Our definition: an order is inconsistent when its product-row count
    differs from its largest add_to_cart_order (a gap or a repeat in the
    cart sequence)."""
    per_order = fp.groupBy("order_id").agg(
        rows().alias("n"), F.max("add_to_cart_order").alias("max_cart"))
    return per_order.agg(
        F.count(F.lit(1)).alias("orders_checked"),
        F.count_if(F.col("max_cart").isNull() | (F.col("n") != F.col("max_cart")))
        .alias("inconsistent_orders"),
    )


def load_metrics(fo: DataFrame, fp: DataFrame) -> DataFrame:
    """The gate's counts in one row: one aggregate job per table, the two
    one-row results stacked and folded (no join needed)."""
    cols = ["orders_count", "products_count", "duplicate_orders",
            "invalid_order_dow", "invalid_order_hour"]
    none = F.lit(None).cast("bigint")
    order_side = fo.agg(
        rows().alias("orders_count"),
        none.alias("products_count"),
        (rows() - F.count_distinct("order_id")).alias("duplicate_orders"),
        F.count_if(bad_dow()).alias("invalid_order_dow"),
        F.count_if(bad_hour()).alias("invalid_order_hour"),
    )
    product_side = fp.agg(rows().alias("products_count")).select(
        *[(F.col(c) if c == "products_count" else none).alias(c) for c in cols])
    return order_side.select(*cols).unionByName(product_side).agg(
        *[F.max(c).alias(c) for c in cols])


class LoadValidationError(ValueError):
    """The load gate failed; the message names the first failing rule."""


@dataclass(frozen=True)
class LoadReport:
    orders_count: int
    products_count: int
    duplicate_orders: int
    invalid_order_dow: int
    invalid_order_hour: int


def validate_load(fo: DataFrame, fp: DataFrame) -> LoadReport:
    """Run the gate: raise on the first failing rule, in the reference's order
    (empty orders, duplicates, bad day of week, bad hour). The product count
    is reported, not checked."""
    return check_report(load_report(fo, fp))


def load_report(fo: DataFrame, fp: DataFrame) -> LoadReport:
    """The gate's counts, from a scan of both facts."""
    row = load_metrics(fo, fp).first()
    return LoadReport(**{k: int(row[k]) for k in row.asDict()})


def check_report(report: LoadReport) -> LoadReport:
    """Raise on the first failing rule of the gate."""
    if report.orders_count == 0:
        raise LoadValidationError("fact_orders is empty")
    if report.duplicate_orders > 0:
        raise LoadValidationError(f"duplicate order_id rows: {report.duplicate_orders}")
    if report.invalid_order_dow > 0:
        raise LoadValidationError(f"invalid order_dow rows: {report.invalid_order_dow}")
    if report.invalid_order_hour > 0:
        raise LoadValidationError(f"invalid order_hour_of_day rows: {report.invalid_order_hour}")
    return report
