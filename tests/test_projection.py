import datetime as dt

import pytest
from pyspark.sql import functions as F

from sluiceway.functions import StreamSpec, normalize_numbers, to_struct
from sluiceway.operators import (
    flatten, map_stream, parse_records, project_denormalized, project_fixed, split_valid, stamp_metadata, typed_view, view_columns,
)
from sluiceway.operators.mapping import apply_stream_map
from sluiceway.session import prepare_session
from sluiceway.sources import as_messages

from .conftest import day, lines, plan, record, rows

META = ["_sdc_extracted_at", "_sdc_received_at", "_sdc_batched_at", "_sdc_deleted_at", "_sdc_sequence", "_sdc_table_version"]


def frame(spark, bodies, **more):
    return as_messages(lines(spark, [record("s", b, **more) for b in bodies]))


def spec(properties, keys=()):
    return StreamSpec("s", {"properties": properties}, tuple(keys))


def typed(spark, properties, bodies, rules=None, resolver=1):
    out = project_denormalized(frame(spark, bodies), spec(properties), rules, resolver).drop(*META)
    return [r.asDict(True) for r in out.collect()]


LINES = {"type": "array", "items": {"type": "object", "properties": {"LineNumber": {"type": "integer"}, "ShipMode": {"type": "string"}}}}
NESTED = {"Customer": {"type": "object", "properties": {"CustKey": {"type": "integer"}, "LastOrder": {"type": "object", "properties": {"OrderLines": LINES}}}}}


@pytest.mark.parametrize("count", [1, 3])
def test_nested_names_change_in_data_and_schema(spark, count):
    sent = [{"LineNumber": i, "ShipMode": "RAIL"} for i in range(count)]
    kept = [{"line_number": i, "ship_mode": "RAIL"} for i in range(count)]
    got = typed(spark, NESTED, [{"Customer": {"CustKey": 7, "LastOrder": {"OrderLines": sent}}}], {"snake_case": True})
    assert got == [{"customer": {"cust_key": 7, "last_order": {"order_lines": kept}}}]


def test_names_with_dots_and_case_twins(spark):
    properties = {"a.b": {"type": "integer"}, "Id": {"type": "integer"}, "id": {"type": "integer"}, "version": {"type": "string"}, "seq": {"type": "string"}}
    got = typed(spark, properties, [{"a.b": 1, "Id": 2, "id": 3, "version": "v", "seq": "q"}])
    assert got == [{"a.b": 1, "Id": 2, "id_1": 3, "version": "v", "seq": "q"}]
    assert typed(spark, properties, [{"a.b": 1}], {"replace_period_with_underscore": True})[0]["a_b"] == 1


def test_unknown_keys_are_dropped_and_absent_ones_null(spark):
    assert typed(spark, {"a": {"type": "integer"}, "b": {"type": "string"}}, [{"a": 1, "zzz": 2}]) == [{"a": 1, "b": None}]


def test_values_of_every_type(spark):
    properties = {
        "i": {"type": "integer"}, "n": {"type": "number"}, "b": {"type": "boolean"}, "s": {"type": "string"},
        "t": {"type": "string", "format": "date-time"}, "d": {"type": "string", "format": "date"},
        "c": {"type": "string", "format": "time"}, "j": {"type": "object"}, "a": {"type": "array"},
    }
    body = {"i": 2**53 + 1, "n": 0.1, "b": True, "s": "é\"\\\n", "t": "1998-03-15T23:30:00.250125-05:30", "d": "2024-02-29",
            "c": "10:11:12", "j": {"x": [1]}, "a": [1, "two", None]}
    got = project_denormalized(frame(spark, [body]), spec(properties))
    row = got.select("i", "n", "b", "s", "t", "d", "c", F.to_json("j"), F.transform("a", lambda v: F.to_json(v))).first()
    assert tuple(row) == (
        2**53 + 1, 0.1, True, "é\"\\\n", dt.datetime(1998, 3, 16, 5, 0, 0, 250125), dt.date(2024, 2, 29),
        "10:11:12", '{"x":[1]}', ["1", '"two"', "null"],
    )


def corrupt(spark, properties, bodies):
    out = parse_records(as_messages(lines(spark, [b if isinstance(b, str) else record("s", b) for b in bodies])), spec(properties))
    return [(r.record, r._corrupt_record is None) for r in out.collect()]


def test_whole_numbers_fit_integers_and_fractions_do_not(spark):
    got = corrupt(spark, {"id": {"type": "integer"}}, [{"id": 1.0}, {"id": 1.5}, {"id": "x"}, {"id": 7}, {"id": None}])
    assert [(r and r.id, ok) for r, ok in got] == [(1, True), (None, False), (None, False), (7, True), (None, True)]


def test_second_look_does_not_touch_text(spark):
    body = {"id": 3.0, "note": 'x: 1.0, {"y": 2.0}'}
    [(got, ok)] = corrupt(spark, {"id": {"type": "integer"}, "note": {"type": "string"}}, [body])
    assert ok and got.note == body["note"] and got.id == 3


@pytest.mark.parametrize("line", [
    '{"type":"RECORD","stream":"s"}', '{"type":"RECORD","stream":"s","record":null}', '{"type":"RECORD","stream":"s","record":[1]}',
    '{"type":"RECORD","stream":"s","record":"text"}',
])
def test_records_that_are_no_object(spark, line):
    assert [ok for _, ok in corrupt(spark, {"id": {"type": "integer"}}, [line])] == [False]


def test_each_line_is_parsed_once(spark):
    out = project_denormalized(frame(spark, [{"a": 1}]), spec({"a": {"type": "integer"}}), {"snake_case": True}, as_of=day(1))
    text = plan(out)
    assert text.count("from_json(StructField(type,") == 1


# ---- fixed shape ----------------------------------------------------------


def test_metadata_keys_move_out_of_data(spark):
    body = {"id": 1, "name": "Clerk#7", "_sdc_extracted_at": "1996-03-13T06:30:00Z", "_sdc_sequence": 1996, "_sdc_other": 1}
    row = project_fixed(frame(spark, [body]), "s").withColumn("data", F.to_json("data")).first()
    assert tuple(row) == ('{"_sdc_other":1,"id":1,"name":"Clerk#7"}', dt.datetime(1996, 3, 13, 6, 30), None, None, None, 1996, None)


def test_metadata_keys_written_with_escapes(spark):
    line = '{"type":"RECORD","stream":"s","record":{"\\u005fsdc_sequence":5,"a":1}}'
    row = project_fixed(as_messages(lines(spark, [line])), "s").select(F.to_json("data").alias("d"), "_sdc_sequence").first()
    assert tuple(row) == ('{"a":1}', 5)


def test_the_last_of_repeated_keys_counts(spark):
    prepare_session(spark)
    line = '{"type":"RECORD","stream":"s","record":{"a":1,"a":2}}'
    assert project_fixed(as_messages(lines(spark, [line])), "s").select(F.to_json("data")).first()[0] == '{"a":2}'
    assert project_denormalized(as_messages(lines(spark, [line])), spec({"a": {"type": "integer"}})).first().a == 2


def test_nested_metadata_names_stay(spark):
    body = {"a": {"_sdc_sequence": 1}, "t": "_sdc_sequence"}
    assert project_fixed(frame(spark, [body]), "s").select(F.to_json("data")).first()[0] == '{"a":{"_sdc_sequence":1},"t":"_sdc_sequence"}'


def test_stamps(spark):
    msgs = frame(spark, [{"a": 1}, {"a": 2, "_sdc_extracted_at": "2020-01-01T00:00:00Z", "_sdc_deleted_at": "2021-01-01T00:00:00Z"}],
                 extracted="2023-01-01T00:00:00Z", version=9)
    for out in (project_fixed(msgs, "s", day(2)), project_denormalized(msgs, spec({"a": {"type": "integer"}}), as_of=day(2))):
        got = sorted((tuple(r) for r in out.select(*META).collect()), key=str)
        at, seq = dt.datetime(2024, 1, 2), 1704153600000
        assert got == [
            (dt.datetime(2020, 1, 1), at, at, dt.datetime(2021, 1, 1), seq, 9),
            (dt.datetime(2023, 1, 1), at, at, None, seq, 9),
        ]
    plainly = stamp_metadata(spark.createDataFrame([(1,)], "a INT"), "2024-01-02T00:00:00", day(1)).first()
    assert plainly._sdc_received_at == dt.datetime(2024, 1, 2) and plainly._sdc_batched_at == dt.datetime(2024, 1, 1)


def test_key_presence(spark):
    bodies = [{"id": 1}, {"other": 1}, {"id": None}, {"ID": 1}]
    fixed = project_fixed(frame(spark, bodies), "s")
    good, bad = split_valid(fixed, ["id"])
    assert (good.count(), bad.count()) == (2, 2)
    as_text = fixed.withColumn("data", F.to_json("data"))
    assert split_valid(as_text, ["id"])[0].count() == 2
    assert split_valid(fixed, [])[0].count() == 4
    broken = spark.createDataFrame([("{broken",), ('{"id":1}',)], "data STRING")
    assert split_valid(broken, ["id"])[1].count() == 1
    hidden = project_denormalized(frame(spark, bodies), spec({"id": {"type": "integer"}}, ["id"]), hidden=True)
    assert hidden.filter("__reject is null").count() == 2
    undeclared = project_denormalized(frame(spark, bodies), spec({"x": {"type": "integer"}}, ["id"]), hidden=True)
    assert undeclared.filter("__reject is null").count() == 2


# ---- typed view -----------------------------------------------------------


def seen(spark, properties, bodies, **options):
    out = typed_view(project_fixed(frame(spark, bodies), "s"), to_struct({"properties": properties}), **options)
    return [r.asDict(True) for r in out.collect()]


def test_view_values(spark):
    properties = {
        "OrderKey": {"type": "integer"}, "priority": {"type": "string"}, "orderDate": {"type": "string", "format": "date-time"},
        "customer": {"type": "object", "properties": {"address": {"type": "object", "properties": {
            "nation": {"type": "string"}, "phones": {"type": "array", "items": {"type": "string"}}}},
            "active": {"type": "boolean"}, "balance": {"type": "number"}}},
    }
    full = {"OrderKey": 3, "priority": 12.50, "orderDate": "1996-01-02T00:00:00Z",
            "customer": {"address": {"nation": True, "phones": ["a", None, 5, {"no": 1}]}, "active": True, "balance": 1}}
    got = seen(spark, properties, [full, {}], rules={"snake_case": True})
    assert got[0] == {
        "order_key": 3, "priority": "12.5", "order_date": dt.datetime(1996, 1, 2),
        "customer": {"address": {"nation": "true", "phones": ["a", "5"]}, "active": True, "balance": 1.0},
    }
    assert got[1] == {"order_key": None, "priority": None, "order_date": None,
                      "customer": {"address": {"nation": None, "phones": []}, "active": None, "balance": None}}


def test_text_that_looks_like_json_is_text(spark):
    got = seen(spark, {"t": {"type": "string"}}, [{"t": '{"a":1}'}, {"t": "[x"}, {"t": {"a": 1}}, {"t": [1]}, {"t": None}])
    assert [r["t"] for r in got] == ['{"a":1}', "[x", None, None, None]


def test_arrays_of_records(spark):
    item = {"type": "object", "properties": {"PartKey": {"type": "integer"}, "deep": {"type": "object", "properties": {"x": {"type": "integer"}}},
                                             "list": {"type": "array", "items": {"type": "object", "properties": {"y": {"type": "integer"}}}}}}
    body = {"SupplierRows": [{"PartKey": 1, "deep": {"x": 2}, "list": [{"y": 3}, None]}, None]}
    got = seen(spark, {"SupplierRows": {"type": "array", "items": item}}, [body, {}, {"SupplierRows": "no array"}], rules={"snake_case": True})
    assert got[0]["supplier_rows"] == [
        {"part_key": 1, "deep": {"x": 2}, "list": [{"y": 3}, {"y": None}]},
        {"part_key": None, "deep": {"x": None}, "list": []},
    ]
    assert got[1]["supplier_rows"] == [] and got[2]["supplier_rows"] == []


def test_json_columns(spark):
    properties = {"props": {"type": "object"}, "tags": {"type": "array", "items": {"type": "string"}}, "rest": {"type": "array"}}
    out = typed_view(project_fixed(frame(spark, [{"props": {"a": [1]}, "tags": ["x"], "rest": [1, None]}]), "s"), to_struct({"properties": properties}))
    row = out.select(F.to_json("props"), "tags", F.transform("rest", lambda v: F.to_json(v))).first()
    assert tuple(row) == ('{"a":[1]}', ["x"], ["1", "null"])


def test_odd_names_are_read_literally(spark):
    properties = {n: {"type": "integer"} for n in ("a.b", "it's", 'say "hi"', "back\\slash", "a b", "`q")}
    body = {n: i for i, n in enumerate(properties)}
    got = seen(spark, properties, [{**body, "a": {"b": 99}}])
    assert list(got[0].values()) == list(range(6))


@pytest.mark.parametrize("kind, value", [("integer", "x"), ("integer", 1.5), ("integer", {"a": 1}), ("number", "x"), ("boolean", "maybe")])
def test_strict_view_fails_and_lenient_view_gives_null(spark, kind, value):
    with pytest.raises(Exception):
        seen(spark, {"v": {"type": kind}}, [{"v": value}])
    assert seen(spark, {"v": {"type": kind}}, [{"v": value}], strict=False) == [{"v": None}]


def test_view_timestamp_format(spark):
    properties = {"at": {"type": ["string", "null"], "format": "date-time"}}
    options = {"ts_format": "%Y-%m-%d %H:%M:%S %z"}
    assert seen(spark, properties, [{"at": "2024-05-06 07:08:09 +0200"}], **options) == [{"at": dt.datetime(2024, 5, 6, 5, 8, 9)}]
    assert seen(spark, properties, [{"at": "2024"}, {}], strict=False, **options) == [{"at": None}, {"at": None}]
    with pytest.raises(ValueError):
        seen(spark, properties, [{}], ts_format="%Q")


def test_view_metadata_columns():
    struct = to_struct({"properties": {n: {"type": "string", "format": "date-time"} for n in ("_sdc_extracted_at", "_sdc_sync_started_at", "at")}})
    columns = view_columns(struct)
    assert [n for _, n in columns] == ["_sdc_extracted_at", "at"]
    assert columns[0][0] == "`_sdc_extracted_at`"


def test_view_over_files_reads_only_the_paths_it_shows(spark, tmp_path):
    properties = {f"c{i}": {"type": "number"} for i in range(20)}
    project_fixed(frame(spark, [{f"c{i}": i + 0.5 for i in range(20)}]), "s").write.parquet(str(tmp_path / "f"))
    out = typed_view(spark.read.parquet(str(tmp_path / "f")), to_struct({"properties": properties})).select("c3", "c7")
    assert "ReadSchema: struct<data:struct<0:double,1:double>>" in plan(out)
    assert rows(out) == [(3.5, 7.5)]


# ---- numbers, maps, flattening --------------------------------------------


def test_decimals_become_plain_numbers(spark):
    df = spark.sql("SELECT 1BD AS id, 12.34BD AS amount, array(named_struct('quantity', 2.00BD)) AS items, 'x' AS s, cast(null as decimal(3,1)) AS none")
    out = normalize_numbers(df)
    assert tuple(out.select(F.to_json("id"), F.to_json("amount"), F.to_json("items"), "s", "none").first()) == (
        "1", "12.34", '[{"quantity":2}]', "x", None)


def test_stream_map(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0)], "id INT, name STRING, x DOUBLE")
    out = map_stream(df, {"name": None, "x": "x * 2", "new": "concat(name, config.suffix)"}, "id > 1", config={"suffix": "!"})
    assert out.columns == ["id", "x", "new"] and rows(out) == [(2, 6.0, "b!")]
    only = apply_stream_map(df, {"__else__": None, "__filter__": "id = 1", "key": "id"})
    assert only.columns == ["key"] and rows(only) == [(1,)]


def test_flatten(spark):
    df = spark.createDataFrame([(1, ((2, (3,)), [(4,)]))], "id INT, a STRUCT<b: STRUCT<c: INT, d: STRUCT<e: INT>>, l: ARRAY<STRUCT<x: INT>>>")
    assert flatten(df, 0).columns == ["id", "a"]
    one = flatten(df, 1)
    assert one.columns == ["id", "a__b", "a__l"] and one.first().a__b == '{"c":2,"d":{"e":3}}'
    assert flatten(df, 3).columns == ["id", "a__b__c", "a__b__d__e", "a__l"]
    assert flatten(df, 9).first()[:3] == (1, 2, 3)
