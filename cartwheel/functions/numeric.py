"""Ratios and rounding with the reference's numeric semantics.

* Rounding is half-even (``bround``): 2405 items / 200 orders = 12.025 must
  print as 12.02.
* ``x * 100.0 / n`` is a DOUBLE ratio (a bare ``100.0`` literal would be a
  DECIMAL in Spark SQL), and a zero denominator yields NULL instead of the
  ANSI divide-by-zero error.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, functions as F


def round2(x: Column) -> Column:
    return F.bround(x.cast("double"), 2)


def pct_of(part: Column, whole: Column) -> Column:
    """``round(part * 100.0 / whole, 2)``, NULL when ``whole`` is 0."""
    return round2(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")))


def share_of_total(n: Column) -> Column:
    """Percentage of ``n`` in the sum of ``n`` over the whole relation.

    Used only on already-aggregated rows (a handful of label groups), so the
    single-partition window it implies moves a few rows, not the data.
    """
    return pct_of(n, F.sum(n).over(Window.partitionBy()))
