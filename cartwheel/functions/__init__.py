"""Column-level helpers: coercion, labels, ratios."""

from cartwheel.functions.coerce import to_double, to_long, to_text
from cartwheel.functions.labels import (
    basket_size_category,
    day_name,
    hour_label,
    reorder_interval,
    reorder_status,
)
from cartwheel.functions.numeric import pct_of, round2, share_of_total

__all__ = [
    "to_long", "to_double", "to_text",
    "day_name", "hour_label", "reorder_interval", "reorder_status", "basket_size_category",
    "round2", "pct_of", "share_of_total",
]
