"""What a load does not take over as it is written, one row for each value, with the reason.

==============  ====================================================================
not a number    a value of a numeric column is there but does not coerce; it loads as
                NULL, and the row does not load at all if the column is its key
missing key     an order without order id or user id, or a product of an order without
                order id: the row does not load (of several rows of an order the first
                decides, so a later one without a user costs nothing)
not a list      a ``products`` cell that is no JSON list: the order has no products
not an object   an element of a ``products`` list that is no object: no product
==============  ====================================================================

Blank text counts as missing, not as a number gone wrong. Rows that de-duplication leaves out
are no rejects. One narrow pass over the raw frame with built-in functions, no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from cartwheel.functions.coerce import to_double, to_long, variant_to_long
from cartwheel.operators.facts import NUMERIC_ORDER_COLUMNS, require_columns
from cartwheel.operators.products import products_variant
from cartwheel.schemas import (
    ORDER_COLUMNS,
    PRODUCT_INT_FIELDS,
    PRODUCTS_COLUMN,
    ROW_BLOCK,
    ROW_INDEX,
    SOURCE_FILE,
)

NOT_A_NUMBER, MISSING_KEY, NOT_A_LIST, NOT_AN_OBJECT = (
    "not a number", "missing key", "not a list", "not an object")
ORDER, CELL, PRODUCT = "order", "products", "product"

_LIST, _ELEMENTS = "__list", "__elements"
_FIELDS = "array<struct<{}>>".format(", ".join(f"{f}: variant" for f in PRODUCT_INT_FIELDS))
_REJECT = "entity string, column_name string, list_position int, value string, reason string"
REJECTS = f"{SOURCE_FILE} string, {ROW_BLOCK} bigint, {ROW_INDEX} bigint, {_REJECT}"


def _reject(entity: str, column: str, position: Column, value: Column, reason: str) -> Column:
    return F.struct(F.lit(entity).alias("entity"), F.lit(column).alias("column_name"),
                    position.cast("int").alias("list_position"), value.alias("value"),
                    F.lit(reason).alias("reason"))


def _blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == F.lit(""))


def _order_rejects(raw: DataFrame) -> list[tuple[Column, Column]]:
    """(condition, reject) of a row's order columns and of its ``products`` cell as a whole;
    the cell's list is in ``__elements``."""
    dtypes = {f.name: f.dataType for f in raw.schema.fields}
    nowhere, found = F.lit(None), []
    for c in NUMERIC_ORDER_COLUMNS:
        text = F.col(c).cast("string")
        coerced = (to_double if c == "days_since_prior_order" else to_long)(F.col(c), dtypes[c])
        found.append((~_blank(text) & coerced.isNull(), _reject(ORDER, c, nowhere, text, NOT_A_NUMBER)))
        if c in ("order_id", "user_id"):
            found.append((_blank(text), _reject(ORDER, c, nowhere, text, MISSING_KEY)))
    if PRODUCTS_COLUMN in dtypes:
        cell = F.col(PRODUCTS_COLUMN)
        text = cell.cast("string") if isinstance(dtypes[PRODUCTS_COLUMN], T.AtomicType) else F.to_json(cell)
        found.append((~_blank(text) & F.col(_ELEMENTS).isNull(),
                      _reject(CELL, PRODUCTS_COLUMN, nowhere, text, NOT_A_LIST)))
    return found


def _product_rejects() -> list[tuple[Column, Column]]:
    """(condition, reject) of the list element ``__item`` at ``pos``; ``__fields`` has its numbers
    if it is an object."""
    item, pos, is_object = F.col("element.__item"), F.col("pos"), F.col("element.__fields").isNotNull()
    text = F.coalesce(F.try_variant_get(item, "$", "string"), F.lit("null"))
    found = [(~is_object, _reject(PRODUCT, PRODUCTS_COLUMN, pos, text, NOT_AN_OBJECT)),
             (is_object & ~F.col("has_key"), _reject(PRODUCT, "order_id", pos, F.lit(None).cast("string"), MISSING_KEY))]
    for c in PRODUCT_INT_FIELDS:
        value = F.col(f"element.__fields.{c}")
        text = F.try_variant_get(value, "$", "string")
        found.append((~_blank(text) & variant_to_long(value).isNull(), _reject(PRODUCT, c, pos, text, NOT_A_NUMBER)))
    return found


def _any(found: list[tuple[Column, Column]]) -> Column:
    return reduce(Column.__or__, [F.coalesce(condition, F.lit(False)) for condition, _ in found])


def _listed(found: list[tuple[Column, Column]]) -> Column:
    """The rejects, with NULL where the condition does not hold. No ``array_compact``: a lambda has
    no generated code, and all below it would be interpreted value by value."""
    return F.array(*[F.when(condition, reject) for condition, reject in found])


def rejected_values(raw: DataFrame) -> DataFrame:
    """One row (``REJECTS``) for each value or element of a raw order frame that is not loaded
    as written. Columns of the place in the source are NULL where the frame has none.

    Rejects are built only for rows and elements that have one; the others are passed over by
    conditions in generated code."""
    require_columns(raw, ORDER_COLUMNS, "rejected values")
    types = {f.name: f.dataType for f in T.StructType.fromDDL(REJECTS).fields}
    place = [(F.col(c) if c in raw.columns else F.lit(None)).cast(types[c]).alias(c)
             for c in (SOURCE_FILE, ROW_BLOCK, ROW_INDEX)]
    names = [SOURCE_FILE, ROW_BLOCK, ROW_INDEX]
    if PRODUCTS_COLUMN not in raw.columns:
        orders = _order_rejects(raw)
        return _one_each(raw.where(_any(orders)).select(*place, F.explode(_listed(orders)).alias("reject")), names)
    # A cell is parsed once, for its own reject and for its elements; what is computed for a row comes
    # before its list is taken apart, as everything beside a generator is computed for each element.
    raw = raw.withColumn(_LIST, products_variant(F.col(PRODUCTS_COLUMN), raw.schema[PRODUCTS_COLUMN].dataType))
    raw = raw.withColumns({"__item": F.try_variant_get(_LIST, "$", "array<variant>"), "__fields": F.try_variant_get(_LIST, "$", _FIELDS)})
    raw = raw.withColumn(_ELEMENTS, F.arrays_zip("__item", "__fields"))
    orders = _order_rejects(raw)
    has_key = to_long(F.col("order_id"), raw.schema["order_id"].dataType).isNotNull()
    rows = raw.select(*place, has_key.alias("has_key"), F.when(_any(orders), _listed(orders)).alias("of_order"), _ELEMENTS)
    rows = rows.select(*names, "has_key", "of_order", F.posexplode_outer(_ELEMENTS).alias("pos", "element"))
    # what concerns the whole row comes with its first element, or with the row that an empty list leaves
    rows = rows.withColumn("of_order", F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col("of_order")))
    products = _product_rejects()
    is_element = F.col("pos").isNotNull()
    rows = rows.where(F.col("of_order").isNotNull() | (is_element & _any(products)))
    none = F.array().cast(f"array<struct<{_REJECT.replace(' string', ':string').replace(' int', ':int')}>>")
    found = F.concat(F.coalesce("of_order", none), F.coalesce(F.when(is_element, _listed(products)), none))
    return _one_each(rows.select(*names, F.explode(found).alias("reject")), names)


def _one_each(rows: DataFrame, names: list[str]) -> DataFrame:
    return rows.where(F.col("reject").isNotNull()).select(*names, "reject.*")


def empty_rejects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REJECTS)


def unparsed_cells() -> Column:
    """Aggregate over rejected values: ``products`` cells that are no JSON list."""
    return F.count_if(F.col("reason") == NOT_A_LIST)


def failed_order_values() -> Column:
    """Aggregate over rejected values: order values that do not coerce."""
    return F.count_if((F.col("entity") == ORDER) & (F.col("reason") == NOT_A_NUMBER))
