"""Dashboard labels: day names, reorder intervals, reorder status, basket sizes.

Each helper is a single CASE expression (``F.when`` chain), evaluated in
the listed order, exactly like the SQL ``multiIf`` it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# --- Fixed values: label texts that must equal the reference's output. ---
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
UNKNOWN = "Unknown"
INTERVAL_SAME_DAY = "Same Day"
INTERVAL_BANDS = [(1, 7, "1-7 Days"), (8, 14, "8-14 Days"), (15, 21, "15-21 Days")]
INTERVAL_OVER = (21, ">21 Days")
REORDERED = "Reordered"
NOT_REORDERED = "Not Reordered"
BASKET_BANDS = [
    (1, 5, "Small Basket (1-5)"),
    (6, 10, "Medium Basket (6-10)"),
    (11, 20, "Large Basket (11-20)"),
]
BASKET_OVER = (20, "Very Large Basket (>20)")
HOUR_SUFFIX = ":00"
# --- end of fixed values ---


def day_name(dow: Column) -> Column:
    """0 = Sunday … 6 = Saturday; anything else (NULL included) → Unknown."""
    expr = None
    for i, name in enumerate(DAY_NAMES):
        expr = (F.when(dow == i, F.lit(name)) if expr is None
                else expr.when(dow == i, F.lit(name)))
    return expr.otherwise(F.lit(UNKNOWN))


def hour_label(hour: Column) -> Column:
    """``7`` → ``'7:00'`` (no zero padding). NULL hour → NULL, as concat does."""
    return F.concat(hour.cast("string"), F.lit(HOUR_SUFFIX))


def reorder_interval(days: Column) -> Column:
    """Band a (double) day gap. Gaps between bands (0.5, 7.5, negatives) → Unknown."""
    expr = F.when(days.isNull(), F.lit(UNKNOWN)).when(days == 0, F.lit(INTERVAL_SAME_DAY))
    for lo, hi, label in INTERVAL_BANDS:
        expr = expr.when(days.between(lo, hi), F.lit(label))
    return expr.when(days > INTERVAL_OVER[0], F.lit(INTERVAL_OVER[1])).otherwise(F.lit(UNKNOWN))


def reorder_status(reordered: Column) -> Column:
    return (F.when(reordered == 1, F.lit(REORDERED))
            .when(reordered == 0, F.lit(NOT_REORDERED))
            .otherwise(F.lit(UNKNOWN)))


def basket_size_category(total_products: Column) -> Column:
    expr = None
    for lo, hi, label in BASKET_BANDS:
        cond = total_products.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return (expr.when(total_products > BASKET_OVER[0], F.lit(BASKET_OVER[1]))
            .otherwise(F.lit(UNKNOWN)))
