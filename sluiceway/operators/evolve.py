"""Additive schema evolution: new columns and new nested fields are appended, nothing else changes.

Parquet keeps a schema in every file. A table whose schema has grown reads older files by name, at
every depth: a field that a file lacks is null. So evolution touches the catalog alone, no data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import quoted, quoted_table


def missing_fields(existing: T.StructType, incoming: T.StructType) -> list[T.StructField]:
    """Fields of ``incoming`` that ``existing`` lacks, in their order. Names compare without case."""
    have = {f.name.lower() for f in existing.fields}
    return [f for f in incoming.fields if f.name.lower() not in have]


def merged_type(have: T.DataType, incoming: T.DataType) -> T.DataType:
    """The type of a column after evolution: fields that only ``incoming`` has follow those of ``have``, at every depth.

    Types that differ otherwise stay as they are.
    """
    if isinstance(have, T.StructType) and isinstance(incoming, T.StructType):
        return merged_struct(have, incoming)
    if isinstance(have, T.ArrayType) and isinstance(incoming, T.ArrayType):
        return T.ArrayType(merged_type(have.elementType, incoming.elementType), True)
    return have


def merged_struct(have: T.StructType, incoming: T.StructType) -> T.StructType:
    """Fields of both, those of ``have`` first. Names compare without case."""
    given = {f.name.lower(): f.dataType for f in incoming.fields}
    kept = [T.StructField(f.name, merged_type(f.dataType, given.get(f.name.lower(), f.dataType)), True, f.metadata) for f in have.fields]
    return T.StructType([*kept, *missing_fields(have, incoming)])


def evolve_frame(df: DataFrame, incoming: T.StructType) -> DataFrame:
    """Append the missing columns, and missing fields of nested records, as nulls."""
    wide = merged_struct(df.schema, incoming)
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[(conform(F.col(quoted(f.name)), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in wide.fields]
    )


def evolve(target: DataFrame | str, incoming: T.StructType, spark: SparkSession | None = None) -> DataFrame:
    """Append the missing columns and nested fields to a frame, or to a table by name; returns it in its new shape."""
    if isinstance(target, DataFrame):
        return evolve_frame(target, incoming)
    spark = spark or SparkSession.active()
    evolve_table(spark, target, incoming)
    return spark.table(target)


def conform(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """A column in the type its table has, without any silent change of values.

    Absent nested fields are null. A value that the table's type cannot hold (a fraction under an integer, a time of
    day under a date) and a value under a nested field that the table lacks stop the query with an error that names both types.
    """
    if have.simpleString() == want.simpleString():
        return column
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        there = {f.name.lower(): f for f in have.fields}
        parts = [
            conform(column.getField(there[f.name.lower()].name), there[f.name.lower()].dataType, f.dataType)
            if f.name.lower() in there
            else F.lit(None).cast(f.dataType)
            for f in want.fields
        ]
        made = F.struct(*[p.alias(f.name) for p, f in zip(parts, want.fields)])
        known = {f.name.lower() for f in want.fields}
        for f in have.fields:
            if f.name.lower() not in known:
                lost = F.raise_error(F.lit(f"the table has no nested field {f.name!r} to hold a value")).cast(want)
                made = F.when(column.getField(f.name).isNull(), made).otherwise(lost)
        return F.when(column.isNotNull(), made)
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(column, lambda e: conform(e, have.elementType, want.elementType))
    if isinstance(want, T.StringType) and isinstance(have, T.AtomicType):
        return column.cast(want)
    changed = column.try_cast(want)
    same = column.isNull() | changed.cast(have).eqNullSafe(column)
    told = F.raise_error(F.lit(f"a {have.simpleString()} value does not fit a {want.simpleString()} column")).cast(want)
    return F.when(same, changed).otherwise(told)


def column_ddl(field: T.StructField) -> str:
    """One column of a DDL statement, with nested names quoted and its comment kept."""
    return T.StructType([T.StructField(field.name, field.dataType, True, field.metadata)]).toDDL()


def evolve_table(spark: SparkSession, table: str, incoming: T.StructType) -> list[str]:
    """Add the missing columns and nested fields to a table; rows written before read as null. Returns the changed columns."""
    have = spark.table(table).schema
    added = missing_fields(have, incoming)
    wide = merged_struct(have, incoming)
    deeper = [f.name for f, old in zip(wide.fields, have.fields) if f.dataType.simpleString() != old.dataType.simpleString()]
    if deeper:
        _set_columns(spark, table, wide)
    elif added:
        columns = ", ".join(column_ddl(f) for f in added)
        spark.sql(f"ALTER TABLE {quoted_table(table)} ADD COLUMNS ({columns})")
    return [*deeper, *[f.name for f in added]]


def _set_columns(spark: SparkSession, table: str, wide: T.StructType) -> None:
    """Give a Parquet table wider columns. Spark's SQL can append columns but not fields of a struct; this is the catalog
    call behind ``ADD COLUMNS``. Partition columns stay as they are."""
    parts = {c.name for c in spark.catalog.listColumns(table) if c.isPartition}
    data = T.StructType([f for f in wide.fields if f.name not in parts])
    session = spark._jsparkSession
    state = session.sessionState()
    state.catalog().alterTableDataSchema(state.sqlParser().parseTableIdentifier(quoted_table(table)), session.parseDataType(data.json()))
    spark.catalog.refreshTable(table)
