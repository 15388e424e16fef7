"""Row-level operators that turn raw orders into the two fact tables."""

from cartwheel.operators.dedup import keep_first
from cartwheel.operators.facts import (
    build_fact_order_products,
    build_fact_orders,
    require_columns,
)
from cartwheel.operators.products import explode_products, parse_products

__all__ = [
    "keep_first", "build_fact_orders", "build_fact_order_products", "require_columns",
    "parse_products", "explode_products",
]
