import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway.functions import key_names, rename, rename_struct, table_name, table_name_of, transform_name, unique_names

from .conftest import rows

# Names, rules, and the names they must become.
NAMES = [
    ("TestColumn", {"snake_case": True}, "test_column"),
    ("_TestColumn", {"snake_case": True}, "_test_column"),
    ("RANDOMCapsAREHere", {"snake_case": True}, "random_caps_are_here"),
    ("ALLCAPS", {"snake_case": True}, "allcaps"),
    ("ALL_CAPS", {"snake_case": True}, "all_caps"),
    ("SalesforceThing__c", {"snake_case": True}, "salesforce_thing__c"),
    ("column.with.period", {"replace_period_with_underscore": True}, "column_with_period"),
    ("TestColumn", {"lower": True}, "testcolumn"),
    ("TestColumn", {}, "TestColumn"),
    ("`TestColumn`", {}, "`TestColumn`"),
    ("ValidColumn", {"add_underscore_when_invalid": True}, "ValidColumn"),
    ("123InvalidColumn", {"add_underscore_when_invalid": True}, "_123InvalidColumn"),
    ("Shakespeare", {"quote": True}, "`Shakespeare`"),
    ("`Shakespeare`", {"quote": True}, "`Shakespeare`"),
    ("`ANewWorld`", {"snake_case": True}, "`a_new_world`"),
    ("123ANewWorld", {"snake_case": True, "add_underscore_when_invalid": True}, "_123_a_new_world"),
    ("`123ANewWorld`", {"snake_case": True, "add_underscore_when_invalid": True}, "`_123_a_new_world`"),
    ("123ANewWorld", {"snake_case": True, "lower": True, "add_underscore_when_invalid": True, "quote": True}, "`_123_a_new_world`"),
    ("Nested.Value", {"snake_case": True, "replace_period_with_underscore": True}, "nested__value"),
    ("", {"snake_case": True, "add_underscore_when_invalid": True, "lower": True}, ""),
]


@pytest.mark.parametrize("name, rules, expected", NAMES)
def test_column_names(name, rules, expected):
    assert transform_name(name, rules) == expected


def test_unknown_rules_are_ignored():
    assert transform_name("A", {"lower": True, "from_a_later_version": True}) == "a"


@given(st.text(alphabet=st.characters(blacklist_characters="`"), max_size=30))
def test_lower_is_idempotent_and_quotes_survive(name):
    once = transform_name(name, {"lower": True})
    assert transform_name(once, {"lower": True}) == once
    assert transform_name(f"`{name}`", {}) == f"`{name}`"


@given(st.text(alphabet="aAbB1_", min_size=1, max_size=12))
def test_snake_case_has_no_capitals_and_keeps_the_letters(name):
    out = transform_name(name, {"snake_case": True})
    assert out == out.lower()
    assert out.replace("_", "") == name.lower().replace("_", "")


@given(st.lists(st.sampled_from(["a", "A", "a_1", "b", "B"]), max_size=8))
def test_unique_names_are_unique_without_case(names):
    out = unique_names(names)
    assert len({n.lower() for n in out}) == len(names)
    assert all(o.lower().startswith(n.lower()) for o, n in zip(out, names))


def test_repeated_names_get_numbers_in_order():
    assert unique_names(["id", "name", "ID", "id"]) == ["id", "name", "ID_1", "id_2"]


def test_keys_follow_the_rules_without_quotes():
    rules = {"snake_case": True, "replace_period_with_underscore": True, "quote": True}
    assert key_names(["OrderID", "Nested.Value"], rules) == ["order_id", "nested__value"]
    assert key_names(None) == []


STREAM_NAMES = [
    ("Salesforce.Account-Owner", "salesforce_account_owner"),
    ("test:specialchars!in?attributes", "test_specialchars_in_attributes"),
    ("orders", "orders"),
]


def test_table_names(spark):
    assert [table_name_of(s) for s, _ in STREAM_NAMES] == [t for _, t in STREAM_NAMES]
    df = spark.createDataFrame(STREAM_NAMES, "stream STRING, expected STRING")
    assert df.filter(table_name("stream") != F.col("expected")).count() == 0


def test_rename_reaches_structs_and_arrays(spark):
    df = spark.createDataFrame(
        [(1, ([(2,), (3,)],))], "OrderID INT, `Nested.Value` STRUCT<ArrayColumn: ARRAY<STRUCT<InnerID: INT>>>"
    )
    out = rename(df, {"snake_case": True, "replace_period_with_underscore": True})
    assert out.schema.simpleString() == "struct<order_id:int,nested__value:struct<array_column:array<struct<inner_id:int>>>>"
    assert out.first().asDict(True) == {"order_id": 1, "nested__value": {"array_column": [{"inner_id": 2}, {"inner_id": 3}]}}


def test_rename_without_rules_is_identity(spark):
    df = spark.createDataFrame([(1, (2,))], "IntColumn INT, N STRUCT<B: INT>")
    assert rename(df, {}).schema == df.schema
    assert rows(rename(df, None)) == rows(df)


def test_rename_struct_keeps_positions():
    struct = T.StructType([T.StructField("B", T.LongType()), T.StructField("b", T.StringType())])
    assert rename_struct(struct, {"lower": True}).fieldNames() == ["b", "b_1"]
