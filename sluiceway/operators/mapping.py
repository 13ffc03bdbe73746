"""Stream maps (rename, filter and recompute a stream) and schema flattening."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import unique_names
from ..session import quoted

ALIAS, FILTER, ELSE, KEYS = "__alias__", "__filter__", "__else__", "__key_properties__"
_CONTROLS = {ALIAS, FILTER, ELSE, KEYS}


def alias_streams(msgs: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """Give streams of a message frame other names."""
    named = F.col("stream")
    for old, new in aliases.items():
        named = F.when(F.col("stream") == old, F.lit(new)).otherwise(named)
    return msgs.withColumn("stream", named)


def map_stream(
    df: DataFrame,
    exprs: Mapping[str, str | None],
    where: str | None = None,
    keep_others: bool = True,
    config: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Recompute columns with Spark SQL expressions over the incoming row.

    ``None`` drops a column. Unmapped columns stay unless ``keep_others`` is
    off. Values of ``config`` are readable as ``config.<name>``.
    """
    columns = df.columns
    if config:
        df = df.withColumn("config", F.struct(*[F.lit(v).alias(k) for k, v in config.items()]))
    if where:
        df = df.filter(where)
    mapped = {k: v for k, v in exprs.items() if k not in _CONTROLS}
    kept = [] if not keep_others else [c for c in columns if c not in mapped]
    order = [c for c in columns if c in kept or mapped.get(c) is not None]
    order += [c for c in mapped if c not in columns and mapped[c] is not None]
    return df.select(
        *[(F.expr(mapped[c]) if mapped.get(c) is not None else F.col(quoted(c))).alias(c) for c in order]
    )


def apply_stream_map(
    df: DataFrame, settings: Mapping[str, str | None], config: Mapping[str, Any] | None = None
) -> DataFrame:
    """One stream's entry of the ``stream_maps`` setting."""
    keep_others = ELSE not in settings or settings[ELSE] is not None
    return map_stream(df, settings, settings.get(FILTER), keep_others, config)


def _leaves(field: T.StructField, column: Column, name: str, depth: int, sep: str) -> list[tuple[str, Column]]:
    if not isinstance(field.dataType, T.StructType):
        return [(name, column)]
    if depth == 0:
        return [(name, F.to_json(column))]
    return [
        leaf
        for child in field.dataType.fields
        for leaf in _leaves(child, column.getField(child.name), f"{name}{sep}{child.name}", depth - 1, sep)
    ]


def flatten(df: DataFrame, max_depth: int, sep: str = "__") -> DataFrame:
    """Lift fields of nested structs into columns named ``parent__child``.

    ``max_depth`` levels are lifted; structs below that become JSON text. Arrays
    stay as they are.
    """
    leaves = [
        leaf for f in df.schema.fields for leaf in _leaves(f, F.col(quoted(f.name)), f.name, max_depth, sep)
    ]
    names = unique_names(name for name, _ in leaves)
    return df.select(*[column.alias(name) for name, (_, column) in zip(names, leaves)])
