import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from sluiceway.functions import FIXED_SCHEMA, StreamSpec, resolve_schema, to_struct
from sluiceway.functions.types import scalar_type, with_metadata
from sluiceway.operators import evolve_frame, missing_fields
from sluiceway.operators.evolve import column_ddl


def one(prop, resolver=1):
    """Type of a single property as text."""
    return to_struct({"properties": {"x": prop}}, resolver)["x"].dataType.simpleString()


SCALARS = [
    ("number", None, "double"), ("integer", None, "bigint"), ("boolean", None, "boolean"), ("string", None, "string"),
    ("string", "date-time", "timestamp"), ("string", "date", "date"), ("number", "time", "string"),
    (["integer", "string"], None, "string"), (["null", "integer"], None, "bigint"), (["number", "integer", "string"], None, "double"),
    ("null", None, "string"), ("integer", "date-time", "timestamp"), ("string", "uuid", "string"),
]


@pytest.mark.parametrize("kinds, fmt, expected", SCALARS)
def test_scalars(kinds, fmt, expected):
    assert scalar_type(kinds, fmt).simpleString() == expected
    prop = {"type": kinds, **({"format": fmt} if fmt else {})}
    assert one(prop) == one(prop, 2) == expected


@given(
    st.lists(st.sampled_from(["string", "integer", "number", "boolean", "null"]), min_size=1, unique=True),
    st.sampled_from([None, "date", "date-time", "time", "email"]),
)
def test_every_kind_has_a_type_and_order_does_not_matter(kinds, fmt):
    found = scalar_type(kinds, fmt)
    assert found.simpleString() in {"string", "bigint", "double", "boolean", "timestamp", "date"}
    assert found == scalar_type(kinds[::-1], fmt)


def test_strict_resolver():
    assert one({}) == "string"
    assert one({"type": "object"}) == "variant"
    assert one({"type": "array"}) == "array<variant>"
    assert one({"type": "array", "items": {"type": ["null", "string"]}}) == "array<string>"
    assert one({"type": "array", "items": {"type": "string", "format": "date"}}) == "array<date>"
    assert one({"type": "array", "items": {"type": "array", "items": {"type": "integer"}}}) == "array<string>"
    assert one({"type": "array", "items": {"type": "object", "properties": {"a": {"type": "integer"}}}}) == "array<struct<a:bigint>>"
    assert one({"type": "array", "items": {"type": "object"}}) == "array<variant>"
    assert one({"type": "object", "patternProperties": {}, "properties": {"a": {"type": "integer"}}}) == "struct<a:bigint>"
    with pytest.raises(ValueError, match="items need a type"):
        one({"type": "array", "items": {}})
    with pytest.raises(TypeError):
        one({"type": None})


def test_lenient_resolver_falls_back_to_json():
    assert one({}, 2) == "variant"
    assert one({"type": None}, 2) == "variant"
    assert one({"type": "object", "properties": {}}, 2) == "variant"
    assert one({"type": "object", "patternProperties": {}, "properties": {"a": {"type": "integer"}}}, 2) == "variant"
    assert one({"type": "string", "patternProperties": {}}, 2) == "variant"
    assert one({"type": "array", "items": {}}, 2) == "array<variant>"
    assert one({"type": "array", "items": {"type": "object", "patternProperties": {}}}, 2) == "array<variant>"
    assert one({"type": "array", "items": None}, 2) == "variant"
    assert one({"type": "object", "properties": {"a": {"type": "integer"}, "b": {}}}, 2) == "struct<a:bigint,b:variant>"


def test_any_of_takes_the_first_option():
    assert one({"anyOf": [{"type": "integer"}, {"type": "string"}]}) == "bigint"
    assert one({"anyOf": [{"type": "string", "format": "date-time"}, {"type": "null"}]}) == "timestamp"
    assert one({"anyOf": [{}, {"type": "integer"}]}) == one({"anyOf": [{}, {"type": "integer"}]}, 2) == "string"
    # an option that is an object or array keeps its members out of reach
    assert one({"anyOf": [{"type": "object", "properties": {"a": {"type": "integer"}}}]}) == "variant"
    assert one({"anyOf": [{"type": "array", "items": {"type": "integer"}}]}) == "array<variant>"
    assert one({"anyOf": [None]}, 2) == "variant"


def test_other_resolvers_are_refused():
    with pytest.raises(ValueError):
        to_struct({}, 3)


def test_many_nested_columns_under_rules():
    lines = {"type": "array", "items": {"type": "object", "properties": {"LineNumber": {"type": "integer"}}}}
    order = {"type": "object", "properties": {"OrderKey": {"type": "integer"}, "ShipMode": {"type": "string"}, "LineItems": lines}}
    out = to_struct({"properties": {f"Quarter{i}": order for i in range(12)}}, rules={"snake_case": True})
    assert out.fieldNames() == [f"quarter{i}" for i in range(12)]
    assert out["quarter7"].dataType.simpleString() == "struct<order_key:bigint,ship_mode:string,line_items:array<struct<line_number:bigint>>>"


def test_shapes():
    spec = StreamSpec("customer", {"properties": {"CustKey": {"type": "integer"}}})
    assert resolve_schema(spec, "fixed") == FIXED_SCHEMA
    assert FIXED_SCHEMA.fieldNames() == [
        "data", "_sdc_extracted_at", "_sdc_received_at", "_sdc_batched_at", "_sdc_deleted_at", "_sdc_sequence", "_sdc_table_version",
    ]
    typed = resolve_schema(spec, "denormalized", rules={"snake_case": True})
    assert typed.fieldNames()[0] == "cust_key" and len(typed) == 7
    assert all(f.nullable for f in typed.fields)
    with pytest.raises(ValueError, match="Invalid table shape: star-shaped"):
        resolve_schema(spec, "star-shaped")


def test_declared_metadata_gets_its_fixed_type():
    out = with_metadata(to_struct({"properties": {"_sdc_sequence": {"type": "string"}, "a": {"type": "integer"}}}))
    assert out.fieldNames()[:2] == ["_sdc_sequence", "a"]
    assert out["_sdc_sequence"].dataType == T.LongType()


def test_evolution_appends_only(spark):
    have = T.StructType([T.StructField("mkt_segment", T.StringType())])
    new = to_struct({"properties": {"MktSegment": {"type": "integer"}, "AcctBal": {"type": "integer"}}}, rules={"snake_case": True})
    assert [f.name for f in missing_fields(have, new)] == ["acct_bal"]
    out = evolve_frame(spark.createDataFrame([("a",)], have), new)
    assert out.schema.simpleString() == "struct<mkt_segment:string,acct_bal:bigint>"
    assert [tuple(r) for r in out.collect()] == [("a", None)]


def test_ddl_quotes_nested_names():
    field = T.StructField("a b", T.StructType([T.StructField("c.d", T.LongType())]))
    assert "`a b`" in column_ddl(field) and "`c.d`" in column_ddl(field)
