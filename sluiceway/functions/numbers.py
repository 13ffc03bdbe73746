"""Decimal normalisation: whole decimals become integers, other decimals plain numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import quoted


def _has_decimal(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.DecimalType):
        return True
    if isinstance(dtype, T.StructType):
        return any(_has_decimal(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_decimal(dtype.elementType)
    return isinstance(dtype, T.MapType) and _has_decimal(dtype.valueType)


def normalize_numbers(df: DataFrame) -> DataFrame:
    """Replace every column that holds decimals, at any depth, by its JSON value.

    The result has two number types, so it lives in a VARIANT: JSON text of the
    column parsed back drops trailing zeros (``2.00`` becomes the integer 2) and
    keeps every other digit. Non-finite numbers have no JSON form and become text.
    """
    return df.select(
        *[
            json_value(F.col(quoted(f.name))).alias(f.name) if _has_decimal(f.dataType) else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def _has_variant(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_variant(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _has_variant(dtype.elementType)
    return isinstance(dtype, T.VariantType)


def json_text(df: DataFrame) -> DataFrame:
    """Columns that hold JSON, at any depth, as JSON text: for sinks that know no VARIANT."""
    return df.select(
        *[
            F.to_json(F.col(quoted(f.name))).alias(f.name) if _has_variant(f.dataType) else F.col(quoted(f.name))
            for f in df.schema.fields
        ]
    )


def json_value(column: Column) -> Column:
    """Any column as VARIANT, by way of its JSON text; explicit nulls are kept."""
    wrapped = F.to_json(F.struct(column.alias("v")), {"ignoreNullFields": "false"})
    return F.when(column.isNotNull(), F.variant_get(F.parse_json(wrapped), "$.v", "variant"))
