"""Parse the ``products`` JSON cell and flatten it to one row per product.

The cell is a total function of its text:

* NULL, blank, invalid or truncated JSON, and JSON that is not a list → no rows;
* a JSON list → one row per element that is an object; numbers, strings,
  nulls and nested lists inside the list are skipped;
* a missing key or JSON null → NULL field; texts are stringified.

Parsing uses the VARIANT type: ``try_parse_json`` never fails, and one
``try_variant_get`` to ``array<struct<…>>`` both rejects non-lists (NULL) and
turns non-object elements into NULL elements, in a single JVM-side pass.
Numeric fields stay VARIANT so the integer rule can tell the JSON boolean
``true`` (a number to Python) from the string ``"true"``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from cartwheel.functions.coerce import to_text, variant_to_long
from cartwheel.schemas import (
    PRODUCT_FIELDS,
    PRODUCT_INT_FIELDS,
    PRODUCT_TEXT_FIELDS,
    PRODUCTS_COLUMN,
)

_ELEMENT = "struct<{}>".format(", ".join(
    f"{f}: {'variant' if f in PRODUCT_INT_FIELDS else 'string'}" for f in PRODUCT_FIELDS))
PRODUCTS_TYPE = f"array<{_ELEMENT}>"


def products_variant(cell: Column, dtype: T.DataType | None = None) -> Column:
    """``products`` cell → VARIANT (NULL when the cell is not JSON)."""
    if isinstance(dtype, T.VariantType):
        return cell
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.try_parse_json(F.to_json(cell))
    return F.try_parse_json(cell.cast("string"))


def parse_products(cell: Column, dtype: T.DataType | None = None) -> Column:
    """``products`` cell → ``array<struct>`` (NULL when the cell is not a JSON list)."""
    return F.try_variant_get(products_variant(cell, dtype), "$", PRODUCTS_TYPE)


def explode_products(raw: DataFrame, carry: list[Column]) -> DataFrame:
    """One row per product object: ``carry`` columns, ``pos`` and the six fields.

    Narrow: no shuffle, it pipelines with the scan in one codegen stage.
    """
    dtype = raw.schema[PRODUCTS_COLUMN].dataType
    items = raw.select(*carry, F.posexplode(parse_products(F.col(PRODUCTS_COLUMN), dtype))
                       .alias("pos", "item"))
    items = items.where(F.col("item").isNotNull())
    fields = [variant_to_long(F.col(f"item.{f}")).alias(f) for f in PRODUCT_INT_FIELDS]
    fields += [to_text(F.col(f"item.{f}"), T.StringType()).alias(f) for f in PRODUCT_TEXT_FIELDS]
    carried = [c for c in items.columns if c not in ("item",)]
    return items.select(*carried, *fields)


def unparsed_cell(cell: Column, dtype: T.DataType | None = None) -> Column:
    """True for a non-blank ``products`` cell that is not a JSON list
    (invalid JSON such as a ``NaN`` token, or a JSON object / scalar): such an
    order contributes no products, so the load counts these cells."""
    text = cell.cast("string")
    blank = cell.isNull() | (F.trim(text) == F.lit(""))
    return ~blank & parse_products(cell, dtype).isNull()
