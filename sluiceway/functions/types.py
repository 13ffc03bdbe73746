"""JSON Schema to Spark schema. Runs once per stream, on metadata only."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

from .names import NameRules, rename_struct, unique_names

# The metadata columns, in table order.
METADATA_COLUMNS: dict[str, T.DataType] = {
    "_sdc_extracted_at": T.TimestampType(),
    "_sdc_received_at": T.TimestampType(),
    "_sdc_batched_at": T.TimestampType(),
    "_sdc_deleted_at": T.TimestampType(),
    "_sdc_sequence": T.LongType(),
    "_sdc_table_version": T.LongType(),
}

_MEANING = {
    "data": "the record without its load metadata",
    "_sdc_extracted_at": "when the source read the record",
    "_sdc_received_at": "when the loader received the record",
    "_sdc_batched_at": "when the batch holding the record began",
    "_sdc_deleted_at": "when the source deleted the record, if it reports deletes",
    "_sdc_sequence": "epoch milliseconds at which the record was queued",
    "_sdc_table_version": "version of the table, as announced by the source",
}

FIXED_SCHEMA = T.StructType(
    [T.StructField("data", T.VariantType(), True, {"comment": _MEANING["data"]})]
    + [T.StructField(n, t, True, {"comment": _MEANING[n]}) for n, t in METADATA_COLUMNS.items()]
)

# A format decides first, then the first kind set the type covers.
FORMAT_TYPES: dict[str, T.DataType] = {
    "date-time": T.TimestampType(),
    "date": T.DateType(),
    "time": T.StringType(),
}
KIND_TYPES: list[tuple[frozenset[str], T.DataType]] = [
    (frozenset({"number"}), T.DoubleType()),
    (frozenset({"integer", "string"}), T.StringType()),
    (frozenset({"integer"}), T.LongType()),
    (frozenset({"boolean"}), T.BooleanType()),
    (frozenset({"object"}), T.StructType()),
]


@dataclass(frozen=True)
class StreamSpec:
    """What a SCHEMA message says about one stream."""

    name: str
    json_schema: Mapping[str, Any] = field(default_factory=dict)
    key_properties: tuple[str, ...] = ()
    bookmark_properties: tuple[str, ...] = ()


def kinds_of(declared: Any) -> frozenset[str]:
    """The JSON Schema ``type`` keyword as a set of kinds."""
    return frozenset([declared] if isinstance(declared, str) else declared)


def scalar_type(declared: Any, fmt: str | None = None) -> T.DataType:
    """Type of a property from its kinds and format; an empty struct stands for a record."""
    if fmt in FORMAT_TYPES:
        return FORMAT_TYPES[fmt]
    kinds = kinds_of(declared)
    return next((t for needed, t in KIND_TYPES if needed <= kinds), T.StringType())


class _Resolver:
    """Types of properties under one resolver version (1 strict, 2 lenient)."""

    def __init__(self, version: int) -> None:
        if version not in (1, 2):
            raise ValueError(f"schema resolver version must be 1 or 2, not {version!r}")
        self.lenient = version == 2

    def property_type(self, prop: Mapping[str, Any]) -> T.DataType:
        if not self.lenient:
            return self._declared(prop)
        try:
            return self._declared(prop)
        except Exception:  # whatever cannot be read as a type is kept as JSON
            return T.VariantType()

    def _declared(self, prop: Mapping[str, Any]) -> T.DataType:
        options = prop.get("anyOf")
        source = options[0] if options else prop  # only the first option counts
        if self.lenient and not options:
            declared = source["type"]
        else:
            declared = source.get("type", "string")
        kinds = kinds_of(declared)
        if "array" in kinds:
            return T.ArrayType(self._element(prop))
        open_ended = self.lenient and "patternProperties" in prop
        if open_ended:
            return T.VariantType()
        if "object" in kinds:
            return self.record_type(prop)
        return scalar_type(kinds, source.get("format"))

    def _element(self, prop: Mapping[str, Any]) -> T.DataType:
        if "items" not in prop:
            return T.VariantType()
        items = prop["items"]
        if self.lenient and ("type" not in items or "patternProperties" in items):
            return T.VariantType()
        if "type" not in items:
            raise ValueError(f"array items need a type under resolver version 1: {items!r}")
        found = scalar_type(items["type"], items.get("format"))
        return self.record_type(items) if isinstance(found, T.StructType) else found

    def record_type(self, prop: Mapping[str, Any]) -> T.DataType:
        properties = prop.get("properties") or {}
        if not properties:
            return T.VariantType()
        return T.StructType([T.StructField(n, self.property_type(p)) for n, p in properties.items()])


def to_struct(
    json_schema: Mapping[str, Any],
    resolver: int = 1,
    rules: NameRules | Mapping[str, bool] | None = None,
) -> T.StructType:
    """Spark schema of a stream. Without ``rules`` the names are the JSON keys."""
    typed = _Resolver(resolver)
    struct = T.StructType(
        [T.StructField(n, typed.property_type(p)) for n, p in (json_schema.get("properties") or {}).items()]
    )
    return struct if rules is None else rename_struct(struct, rules)


def with_metadata(struct: T.StructType) -> T.StructType:
    """Append the metadata columns a stream does not declare; declared ones get their fixed type."""
    declared = [
        T.StructField(f.name, METADATA_COLUMNS.get(f.name, f.dataType), True, f.metadata) for f in struct.fields
    ]
    present = {f.name for f in declared}
    return T.StructType(
        declared + [T.StructField(n, t) for n, t in METADATA_COLUMNS.items() if n not in present]
    )


def resolve_schema(
    spec: StreamSpec,
    shape: str,
    resolver: int = 1,
    rules: NameRules | Mapping[str, bool] | None = None,
) -> T.StructType:
    """Schema of the table a stream lands in, for either table shape."""
    if shape == "fixed":
        return FIXED_SCHEMA
    if shape == "denormalized":
        return rename_struct(with_metadata(to_struct(spec.json_schema, resolver)), rules)
    raise ValueError(f"Invalid table shape: {shape}")


__all__ = [
    "FIXED_SCHEMA", "METADATA_COLUMNS", "StreamSpec", "kinds_of", "resolve_schema",
    "scalar_type", "to_struct", "unique_names", "with_metadata",
]
