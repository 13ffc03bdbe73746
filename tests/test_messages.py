import gzip
import json

import pytest

from sluiceway.sources import (
    as_messages, batch_manifest, latest_state, read_batch_files, read_lines, read_messages, records_of, stream_specs, unknown_streams,
)
from sluiceway.functions import StreamSpec
from sluiceway.sources.messages import LogFacts, log_facts

from .conftest import lines, record, rows, schema, state, write_log

ID = {"id": {"type": ["integer", "null"]}}

TWO_STREAMS = [
    schema("wide", {**ID, "rep_key": {"type": "integer"}, "load_id": {"type": "string"}}, ["id"]),
    *[record("wide", {"id": i, "rep_key": i, "load_id": "x"}) for i in range(5)],
    state({"bookmarks": {"wide": 0}}),
    schema("narrow", ID, ["id"]),
    *[record("narrow", {"id": i}) for i in range(19)],
    state({"bookmarks": {"narrow": 18}}),
]


def test_streams_are_told_apart(spark, tmp_path):
    msgs = read_messages(spark, write_log(tmp_path / "log", TWO_STREAMS))
    assert records_of(msgs, "wide").count() == 5
    assert records_of(msgs, "narrow").count() == 19
    specs = stream_specs(msgs)
    assert specs["wide"].key_properties == ("id",)
    assert list(specs["wide"].json_schema["properties"]) == ["id", "rep_key", "load_id"]


def test_first_schema_and_last_state_by_file_then_line(spark, tmp_path):
    for at, kind in ((1, "integer"), (2, "string")):
        write_log(tmp_path / f"log{at}", [schema("s", {"v": {"type": kind}}, [f"k{at}"]), state({"at": at}), state({"at": at * 10})])
    paths = [str(tmp_path / "log2"), str(tmp_path / "log1")]
    msgs = read_messages(spark, paths)
    assert stream_specs(msgs)["s"].key_properties == ("k1",)
    assert [json.loads(r.state) for r in latest_state(msgs).collect()] == [{"at": 20}]
    facts = log_facts(read_lines(spark, paths))
    assert facts.specs == stream_specs(msgs) and json.loads(facts.state) == {"at": 20}


def test_order_holds_across_splits_of_a_file(spark, tmp_path):
    messages = [state({"at": i, "pad": "x" * 200}) for i in range(3000)]
    path = write_log(tmp_path / "log", messages)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        msgs = read_messages(spark, path)
        assert msgs.rdd.getNumPartitions() > 4
        assert json.loads(latest_state(msgs).first().state)["at"] == 2999
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_escaped_words_are_still_found(spark):
    """JSON may write any letter as an escape; the substring test must not lose such lines."""
    escaped = '{"type":"\\u0053CHEMA","stream":"s","schema":{"properties":{}},"key_properties":[]}'
    bookmark = '{"type":"ST\\u0041TE","value":{"a":1}}'
    msgs = as_messages(lines(spark, [escaped, bookmark, '{"note":"SCHEMA STATE"}', "garbage SCHEMA"]))
    assert list(stream_specs(msgs)) == ["s"]
    assert latest_state(msgs).first().state == '{"a":1}'


def test_a_log_without_state(spark):
    msgs = as_messages(lines(spark, [schema("s", ID)]))
    assert latest_state(msgs).count() == 0
    assert log_facts(msgs) == LogFacts({"s": StreamSpec("s", {"properties": ID})})


def test_records_without_a_schema(spark):
    msgs = as_messages(lines(spark, [schema("a", ID), record("a", {"id": 1}), record("b", {"id": 1}), record("b", {"id": 2})]))
    assert rows(unknown_streams(msgs, ["a"])) == [("b", 2)]
    assert rows(unknown_streams(msgs, [])) == [("a", 1), ("b", 2)]


def test_batch_files(spark, tmp_path):
    path = tmp_path / "b.jsonl.gz"
    with gzip.open(path, "wt") as out:
        out.write('{"id": 1, "extra": true}\n{"id": "not a number"}\n{"id": null}\n')
    msgs = as_messages(lines(spark, [{"type": "BATCH", "stream": "s", "encoding": {"format": "jsonl", "compression": "gzip"}, "manifest": [str(path)]}]))
    manifest = batch_manifest(msgs).collect()
    assert [(r.stream, r.file, r.compression) for r in manifest] == [("s", str(path), "gzip")]
    df = read_batch_files(spark, [r.file for r in manifest], StreamSpec("s", {"properties": ID})).cache()
    assert df.columns == ["id", "_corrupt_record"]
    assert rows(df.filter("_corrupt_record is null"), "id") == [(1,), (None,)]
    assert df.filter("_corrupt_record is not null").count() == 1


@pytest.mark.parametrize("bad", ["", "   ", "garbage", "[1, 2]", "null", '"text"', '{"type": 5}'])
def test_odd_lines_do_not_break_the_scan(spark, bad):
    msgs = as_messages(lines(spark, [bad, record("s", {"id": 1})]))
    assert records_of(msgs, "s").count() == 1
