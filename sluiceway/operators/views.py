"""The typed view over a fixed table.

One set of SQL expressions serves both the DataFrame and the stored view. They
read the VARIANT by path, so with shredded Parquet a query over two columns
reads two columns, not the documents.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..functions.names import NameRules, rename_struct
from ..functions.timeformat import java_pattern
from ..functions.types import METADATA_COLUMNS
from ..session import quoted, sql_text
from .quality import json_path


class _Extraction:
    """SQL for typed values out of a VARIANT."""

    def __init__(self, strict: bool, ts_format: str | None) -> None:
        self.strict = strict
        self.get = "variant_get" if strict else "try_variant_get"
        self.pattern = java_pattern(ts_format) if ts_format else None

    def value(self, base: str, path: tuple[str, ...], dtype: T.DataType, depth: int = 0) -> str:
        where = sql_text(json_path(*path))
        if isinstance(dtype, T.VariantType):
            return f"variant_get({base}, {where}, 'variant')"
        if isinstance(dtype, T.StructType):
            parts = (f"{sql_text(f.name)}, {self.value(base, (*path, source), f.dataType, depth)}" for f, source in _named(dtype))
            return f"named_struct({', '.join(parts)})"
        if isinstance(dtype, T.ArrayType):
            return self._array(base, where, dtype.elementType, depth)
        if isinstance(dtype, T.StringType):
            return self._text(base, where)
        if isinstance(dtype, T.TimestampType) and self.pattern:
            parse = "to_timestamp" if self.strict else "try_to_timestamp"
            return f"{parse}({self._text(base, where)}, {sql_text(self.pattern)})"
        got = f"{self.get}({base}, {where}, '{dtype.simpleString()}')"
        return self._whole(got, base, where) if isinstance(dtype, T.LongType) else got

    def _text(self, base: str, where: str) -> str:
        """A string, number or boolean as text; an object or array is not a value."""
        got = f"variant_get({base}, {where}, 'string')"
        shape = f"schema_of_variant(variant_get({base}, {where}, 'variant'))"
        nested = f"(startswith({got}, '{{') OR startswith({got}, '[')) AND {shape} RLIKE '^(OBJECT|ARRAY)<'"
        return f"CASE WHEN {nested} THEN NULL ELSE {got} END"

    def _whole(self, got: str, base: str, where: str) -> str:
        """An integer. The engine would cut 1.5 down to 1; that is an error, or null if lenient."""
        full = f"try_variant_get({base}, {where}, 'double')"
        refuse = (
            f"CAST(raise_error(concat('not an integer: ', CAST({full} AS STRING))) AS BIGINT)"
            if self.strict
            else "CAST(NULL AS BIGINT)"
        )
        return f"CASE WHEN {full} != floor({full}) THEN {refuse} ELSE {got} END"

    def _array(self, base: str, where: str, element: T.DataType, depth: int) -> str:
        """Elements in order. Null scalars go, null records stay as records of nulls."""
        items = f"try_variant_get({base}, {where}, 'array<variant>')"
        var = f"e{depth}"
        each = f"transform({items}, {var} -> {self.value(var, (), element, depth + 1)})"
        if not isinstance(element, T.StructType):
            each = f"filter({each}, {var} -> {var} IS NOT NULL)"
        return f"coalesce({each}, array())"


def _named(struct: T.StructType) -> list[tuple[T.StructField, str]]:
    """Fields under their final names, each with the JSON key it is read from."""
    return [(f, f.metadata.get("json_key", f.name)) for f in struct.fields]


def _keep_keys(struct: T.StructType, target: T.StructType) -> T.StructType:
    """The renamed struct, with every JSON key remembered beside its new name."""
    def pair(src: T.DataType, dst: T.DataType) -> T.DataType:
        if isinstance(src, T.StructType):
            return _keep_keys(src, dst)
        if isinstance(src, T.ArrayType):
            return T.ArrayType(pair(src.elementType, dst.elementType))
        return dst

    return T.StructType(
        [
            T.StructField(d.name, pair(s.dataType, d.dataType), True, {"json_key": s.name})
            for s, d in zip(struct.fields, target.fields)
        ]
    )


def view_columns(
    struct: T.StructType,
    rules: NameRules | Mapping[str, bool] | None = None,
    ts_format: str | None = None,
    strict: bool = True,
) -> list[tuple[str, str]]:
    """``(SQL expression, column name)`` for every column of the typed view.

    The six metadata columns pass through; other ``_sdc_`` properties are left out.
    """
    shown = T.StructType(
        [f for f in struct.fields if f.name in METADATA_COLUMNS or not f.name.startswith("_sdc_")]
    )
    named = _keep_keys(shown, rename_struct(shown, rules))
    sql = _Extraction(strict, ts_format)
    out = []
    for field, key in _named(named):
        expression = quoted(key) if key in METADATA_COLUMNS else sql.value("data", (key,), field.dataType)
        out.append((expression, field.name))
    return out


def typed_view(
    fixed: DataFrame,
    struct: T.StructType,
    rules: NameRules | Mapping[str, bool] | None = None,
    ts_format: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """Typed columns over a fixed frame.

    ``strict`` (the default) fails a query that meets a value of the wrong type;
    otherwise such values read as null.
    """
    columns = view_columns(struct, rules, ts_format, strict)
    return fixed.selectExpr(*[f"{expression} AS {quoted(name)}" for expression, name in columns])


def view_statement(view: str, table: str, columns: list[tuple[str, str]]) -> str:
    """``CREATE OR REPLACE VIEW`` over a fixed table."""
    from ..session import quoted_table

    body = ",\n  ".join(f"{expression} AS {quoted(name)}" for expression, name in columns)
    return f"CREATE OR REPLACE VIEW {quoted_table(view)} AS\nSELECT\n  {body}\nFROM {quoted_table(table)}"
