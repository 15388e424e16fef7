"""The data contract: raw order columns and the two fact-table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns a raw order frame must carry (the product column is optional).
ORDER_COLUMNS = [
    "order_id",
    "user_id",
    "order_number",
    "order_dow",
    "order_hour_of_day",
    "days_since_prior_order",
    "eval_set",
]
PRODUCTS_COLUMN = "products"

# Keys of one product object inside ``products``.
PRODUCT_FIELDS = [
    "product_id",
    "product_name",
    "aisle",
    "department",
    "add_to_cart_order",
    "reordered",
]
PRODUCT_INT_FIELDS = ["product_id", "add_to_cart_order", "reordered"]
PRODUCT_TEXT_FIELDS = ["product_name", "aisle", "department"]

# Optional provenance columns a raw frame may carry (set by the file readers).
SOURCE_FILE = "source_file"
ROW_BLOCK = "row_block"    # start offset of the file split a row came from (line files)
ROW_INDEX = "row_index"    # position of the row (within its file, or its split)

FACT_ORDERS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("user_id", T.LongType(), False),
    T.StructField("order_number", T.LongType(), True),
    T.StructField("order_dow", T.LongType(), True),
    T.StructField("order_hour_of_day", T.LongType(), True),
    T.StructField("days_since_prior_order", T.DoubleType(), True),
    T.StructField("eval_set", T.StringType(), False),
    T.StructField("loaded_at", T.TimestampType(), False),
])

FACT_ORDER_PRODUCTS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("product_name", T.StringType(), False),
    T.StructField("aisle", T.StringType(), False),
    T.StructField("department", T.StringType(), False),
    T.StructField("add_to_cart_order", T.LongType(), True),
    T.StructField("reordered", T.LongType(), True),
    T.StructField("loaded_at", T.TimestampType(), False),
])

FACT_ORDERS_COLUMNS = FACT_ORDERS.fieldNames()
FACT_ORDER_PRODUCTS_COLUMNS = FACT_ORDER_PRODUCTS.fieldNames()

# The product de-duplication key (nulls compare equal).
PRODUCT_KEY = ["order_id", "product_id", "add_to_cart_order"]


def nullable(schema: T.StructType) -> T.StructType:
    """The same schema with every field nullable (how Parquet reads come back)."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
