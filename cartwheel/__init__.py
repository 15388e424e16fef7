"""cartwheel — Spark-native analytics for orders whose line items arrive nested.

Raw order payloads (JSON) are landed as Parquet, flattened into an order-level
and a product-level fact table with built-in DataFrame expressions, loaded
incrementally with Structured Streaming, gated by data-quality checks and
answered by a fixed set of dashboard queries.
"""

__version__ = "0.1.0"
