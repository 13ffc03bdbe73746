"""The given tables as message logs: what a source would have sent."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions import StreamSpec
from sluiceway.session import scratch_path, prepare_session

_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
AS_OF = dt.datetime(2024, 3, 1, 12, 0, tzinfo=dt.timezone.utc)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Zoned timestamps as wall-clock ones, the way the given tables hold them."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _json_type(dtype: T.DataType) -> dict[str, Any]:
    if isinstance(dtype, T.StructType):
        return {"type": ["object", "null"], "properties": {f.name: _json_type(f.dataType) for f in dtype.fields}}
    if isinstance(dtype, T.ArrayType):
        return {"type": ["array", "null"], "items": _json_type(dtype.elementType)}
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return {"type": ["string", "null"], "format": "date-time"}
    kinds = {"double": "number", "float": "number", "bigint": "integer", "int": "integer", "boolean": "boolean"}
    return {"type": [kinds.get(dtype.simpleString(), "string"), "null"]}


def spec_of(df: DataFrame, stream: str, keys: Sequence[str] = (), **overrides: dict[str, Any]) -> StreamSpec:
    """The schema a source would declare for a frame."""
    properties = {f.name: _json_type(f.dataType) for f in df.schema.fields}
    properties.update(overrides)
    return StreamSpec(stream, {"type": "object", "properties": properties}, tuple(keys))


def record_lines(
    df: DataFrame, stream: str | Column, extracted: Column | str | None = None, nulls: bool = True
) -> DataFrame:
    """One RECORD line per row; ``nulls=False`` leaves null keys out of the record."""
    envelope = [F.lit("RECORD").alias("type"), (F.lit(stream) if isinstance(stream, str) else stream).alias("stream")]
    text = F.to_json(F.struct("*"), {"ignoreNullFields": str(not nulls).lower(), "timestampNTZFormat": _MICROS})
    if extracted is not None:
        when = F.col(extracted) if isinstance(extracted, str) else extracted
        envelope.append(F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("time_extracted"))
    head = F.to_json(F.struct(*envelope))
    line = F.concat(F.regexp_replace(head, r"\}$", ""), F.lit(',"record":'), text, F.lit("}"))
    return df.select(line.alias("payload"))


def schema_line(spark: SparkSession, spec: StreamSpec) -> DataFrame:
    message = {
        "type": "SCHEMA",
        "stream": spec.name,
        "schema": spec.json_schema,
        "key_properties": list(spec.key_properties),
    }
    return spark.createDataFrame([(json.dumps(message),)], "payload STRING")


def state_line(spark: SparkSession, value: Mapping[str, Any]) -> DataFrame:
    return spark.createDataFrame([(json.dumps({"type": "STATE", "value": value}),)], "payload STRING")


def log_of(spark: SparkSession, df: DataFrame, spec: StreamSpec, extracted: Column | str | None = None) -> DataFrame:
    """Schema, records and a bookmark of one stream, as lines."""
    state = state_line(spark, {"bookmarks": {spec.name: {"done": True}}})
    return schema_line(spark, spec).union(record_lines(df, spec.name, extracted)).union(state)


def written_log(spark: SparkSession, parts: Sequence[DataFrame], files: int | None = None) -> str:
    """Write lines as a folder of text files, parts in order; ``files`` per part if given."""
    root = scratch_path(spark, "log")
    for at, part in enumerate(parts):
        (part.coalesce(files) if files else part).write.text(f"{root}/{at:03d}")
    return root


def log_parts(root: str, count: int) -> list[str]:
    return [f"{root}/{at:03d}" for at in range(count)]


def scratch_database(spark: SparkSession) -> str:
    """A database of its own for one run, below the shared scratch folder."""
    name = f"sluiceway_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db')}'")
    return name
