"""Tolerant type coercion: unparseable values become NULL, never an error.

The rules follow pandas' ``to_numeric(errors="coerce")`` followed by a
nullable-integer cast: integral text and whole-valued numbers convert
(``'1.0'`` → 1, ``'1e3'`` → 1000, ``' 7 '`` → 7, booleans → 0/1), while
fractions, NaN, infinities and non-numeric text become NULL. Large integers
given as text stay exact (no trip through double).

Every helper looks at the input column's Spark type at plan time, so an
already-typed column is cast directly and only text pays for parsing. All
of it is built-in expressions: it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType)


def _whole_double_to_long(d: Column) -> Column:
    # NaN % 1 and Infinity % 1 are NaN, which is not equal to 0.
    return F.when((d % F.lit(1.0)) == F.lit(0.0), d.try_cast("bigint"))


# Text that counts as a number. The engine's cast also takes a type suffix
# ('1d', '2.0F'); the source does not.
_SUFFIXED = r"[0-9.]\s*[dDfF]\s*$"


def _text_to_number(s: Column) -> Column:
    return F.when(~s.rlike(_SUFFIXED), s.try_cast("double"))


def _numeric_text_to_long(s: Column) -> Column:
    return F.coalesce(s.try_cast("bigint"), _whole_double_to_long(_text_to_number(s)))


def _text_to_long(s: Column) -> Column:
    # Landed text keeps JSON booleans as 'true' / 'false'; they are numbers
    # to the source (Python bools), so they map to 1 / 0.
    return (
        F.when(s == F.lit("true"), F.lit(1).cast("bigint"))
        .when(s == F.lit("false"), F.lit(0).cast("bigint"))
        .otherwise(_numeric_text_to_long(s))
    )


def to_long(c: Column, dtype: T.DataType | None = None) -> Column:
    """Coerce ``c`` to BIGINT; anything not an exact integer becomes NULL."""
    if isinstance(dtype, _INTEGRAL):
        return c.cast("bigint")
    if isinstance(dtype, T.BooleanType):
        return c.cast("bigint")
    if isinstance(dtype, _FRACTIONAL):
        return _whole_double_to_long(c.cast("double"))
    if isinstance(dtype, T.DecimalType):
        return F.when(c == F.floor(c), c.try_cast("bigint"))
    if isinstance(dtype, T.VariantType):
        return variant_to_long(c)
    if isinstance(dtype, T.NullType):
        return F.lit(None).cast("bigint")
    return _text_to_long(c.cast("string"))


def variant_to_long(v: Column) -> Column:
    """Integer coercion of a JSON scalar held as VARIANT.

    JSON ``true``/``false`` become 1/0 (Python booleans are numbers), while
    the *string* ``"true"`` is text and becomes NULL like any other word.
    """
    kind = F.schema_of_variant(v)
    text = F.try_variant_get(v, "$", "string")
    return (
        F.when(kind == F.lit("BOOLEAN"), F.try_variant_get(v, "$", "boolean").cast("bigint"))
        .otherwise(_numeric_text_to_long(text))
    )


def to_double(c: Column, dtype: T.DataType | None = None) -> Column:
    """Coerce ``c`` to DOUBLE; unparseable → NULL and NaN → NULL.

    NaN must not survive: Spark orders NaN above every number, so a NaN gap
    would be counted as ``>21 Days`` instead of ``Unknown``.
    """
    if isinstance(dtype, T.VariantType):
        d = (F.when(F.schema_of_variant(c) == F.lit("BOOLEAN"), F.try_variant_get(c, "$", "boolean").cast("double"))
             .otherwise(_text_to_number(F.try_variant_get(c, "$", "string"))))
    elif isinstance(dtype, T.NullType):
        return F.lit(None).cast("double")
    elif isinstance(dtype, (*_INTEGRAL, *_FRACTIONAL, T.DecimalType, T.BooleanType)):
        d = c.cast("double")
    else:
        d = _text_to_number(c.cast("string"))
    return F.when(~F.isnan(d), d)


def to_text(c: Column, dtype: T.DataType | None = None) -> Column:
    """Coerce ``c`` to a non-null string: NULL → ``''``, other values stringified."""
    if isinstance(dtype, T.StringType):
        return F.coalesce(c, F.lit(""))
    return F.coalesce(c.cast("string"), F.lit(""))
