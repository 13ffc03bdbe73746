import datetime as dt
import json

import pytest

from sluiceway import LoadConfig, appended_state, read_appended, read_rejected, stream_append, stream_load
from sluiceway.functions import StreamSpec
from sluiceway.plans import LandingTable

from .conftest import day, record, rows, schema, state, write_log

PROPS = {"id": {"type": ["integer", "null"]}, "name": {"type": ["string", "null"]}}
SPEC = StreamSpec("people", {"properties": PROPS}, ("id",))


def at(n):
    return f"2024-01-{n:02d}T00:00:00Z"


def batches(root):
    write_log(root / "b1", [schema("people", PROPS, ["id"]), record("people", {"id": 1, "name": "a"}, at(1)), state({"n": 1})])
    write_log(root / "b2", [record("people", {"id": 1, "name": "b"}, at(2)), record("people", {"id": 2, "name": "c"}, at(2)), state({"n": 2})])
    return str(root / "*")


def test_append_is_visible_per_batch_and_restarts_without_repeats(spark, tmp_path):
    source, out, checkpoint = batches(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    config = LoadConfig(denormalized=True)
    for _ in range(2):
        stream_append(spark, source, SPEC, config, out, checkpoint, 1, clock=lambda: day(1)).awaitTermination()
    assert rows(read_appended(spark, out), "id", "name") == [(1, "a"), (1, "b"), (2, "c")]
    assert json.loads(appended_state(spark, out)) == {"n": 2}
    write_log(tmp_path / "in" / "b3", [record("people", {"id": 3, "name": "d"}), record("others", {"id": 4})])
    stream_append(spark, source, SPEC, config, out, checkpoint, clock=lambda: day(2)).awaitTermination()
    assert read_appended(spark, out).count() == 4 and read_rejected(spark, out).count() == 0
    assert json.loads(appended_state(spark, out)) == {"n": 2}


@pytest.mark.parametrize("fail_fast", [True, False])
def test_append_of_bad_rows(spark, tmp_path, fail_fast):
    log = [record("people", {"id": "x"}), record("people", {"id": 1}), state({"n": 1}), "garbage", state({"n": 2}), record("people", {"name": "no key"})]
    source, out = write_log(tmp_path / "in", log), str(tmp_path / "out")
    config = LoadConfig(denormalized=True, fail_fast=fail_fast)
    query = stream_append(spark, source, SPEC, config, out, str(tmp_path / "cp"), clock=lambda: day(1))
    if fail_fast:
        with pytest.raises(Exception):
            query.awaitTermination()
        assert not list((tmp_path / "out").glob("__outcome=*"))
    else:
        query.awaitTermination()
        assert rows(read_appended(spark, out), "id") == [(1,)]
        bad = read_rejected(spark, out)
        assert [r[0] for r in rows(bad, "reason")] == ["a key property is missing", "not JSON, or a value does not fit its declared type", "not a message"]
        assert ("garbage",) in rows(bad, "raw") and json.loads(appended_state(spark, out)) == {"n": 2}


def test_a_replayed_append_writes_over_its_batch(spark, tmp_path, monkeypatch):
    """The query dies after the folder was written and before Spark noted the batch as done."""
    from sluiceway.streaming import loads
    source, out, checkpoint = batches(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    write_log(tmp_path / "in" / "b3", [record("people", {"id": "x"})])
    config = LoadConfig(denormalized=True, fail_fast=False)
    plain = loads.stream_rows
    calls = []

    def dying(*args, **more):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("lost the driver")
        return plain(*args, **more)

    monkeypatch.setattr(loads, "stream_rows", dying)
    with pytest.raises(Exception, match="lost the driver"):
        stream_append(spark, source, SPEC, config, out, checkpoint, 1, clock=lambda: day(1)).awaitTermination()
    commits = sorted((tmp_path / "cp" / "commits").glob("1"))
    commits[0].unlink()  # the second batch was written, and is run again
    monkeypatch.undo()
    stream_append(spark, source, SPEC, config, out, checkpoint, 1, clock=lambda: day(1)).awaitTermination()
    assert rows(read_appended(spark, out), "id", "name") == [(1, "a"), (1, "b"), (2, "c")]
    assert read_rejected(spark, out).count() == 1 and json.loads(appended_state(spark, out)) == {"n": 2}


@pytest.mark.parametrize("fixed", [False, True])
def test_batches_commit_with_their_bookmark(spark, database, tmp_path, fixed):
    seen = []
    config = {"database": database, "denormalized": not fixed}
    query = stream_load(spark, batches(tmp_path / "in"), config, str(tmp_path / "cp"), 1, clock=lambda: day(1),
                        on_commit=lambda n, results, bookmark: seen.append((n, results[0].rows, json.loads(bookmark))))
    query.awaitTermination()
    assert seen == [(0, 1, {"n": 1}), (1, 2, {"n": 2})]
    assert spark.table(f"{database}.people").count() == 3


def test_upsert_stream_equals_batch_by_batch_merge(spark, database, tmp_path):
    config = {"database": database, "denormalized": True, "upsert": True, "dedupe_before_upsert": True}
    stream_load(spark, batches(tmp_path / "in"), config, str(tmp_path / "cp"), 1, clock=lambda: day(1)).awaitTermination()
    assert rows(spark.table(f"{database}.people"), "id", "name") == [(1, "b"), (2, "c")]
    # a later batch wins even with older rows, unless the guard is on
    write_log(tmp_path / "in" / "b3", [record("people", {"id": 1, "name": "old"}, at(1))])
    stream_load(spark, str(tmp_path / "in" / "*"), {**config, "only_if_newer": True}, str(tmp_path / "cp"), clock=lambda: day(2)).awaitTermination()
    assert rows(spark.table(f"{database}.people"), "id", "name") == [(1, "b"), (2, "c")]


def test_a_replayed_batch_changes_nothing(spark, database, tmp_path):
    """The query dies after the table was published and before Spark noted the batch as done."""
    source, checkpoint = batches(tmp_path / "in"), str(tmp_path / "cp")
    config = {"database": database, "denormalized": True}

    def die(batch, results, bookmark):
        raise RuntimeError("lost the driver")

    with pytest.raises(Exception, match="lost the driver"):
        stream_load(spark, source, config, checkpoint, 1, clock=lambda: day(1), on_commit=die).awaitTermination()
    assert spark.table(f"{database}.people").count() == 1
    stream_load(spark, source, config, checkpoint, 1, clock=lambda: day(2)).awaitTermination()
    assert rows(spark.table(f"{database}.people"), "id", "name") == [(1, "a"), (1, "b"), (2, "c")]
    assert LandingTable.find(spark, f"{database}.people").load_id == 2


def test_a_second_query_does_not_inherit_the_first_ones_batches(spark, database, tmp_path):
    config = {"database": database, "denormalized": True}
    source = batches(tmp_path / "in")
    for n in (1, 2):
        stream_load(spark, source, config, str(tmp_path / f"cp{n}"), clock=lambda: dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc)).awaitTermination()
    assert spark.table(f"{database}.people").count() == 6


def test_a_bad_batch_stops_the_query_before_it_shows(spark, database, tmp_path):
    source, config = batches(tmp_path / "in"), {"database": database, "denormalized": True}
    write_log(tmp_path / "in" / "b3", [record("people", {"id": "x"})])
    with pytest.raises(Exception, match="rejected"):
        stream_load(spark, source, config, str(tmp_path / "cp"), 1, clock=lambda: day(1)).awaitTermination()
    assert spark.table(f"{database}.people").count() == 3


def test_append_stamps_each_batch_with_its_own_time(spark, tmp_path):
    config, out = LoadConfig(denormalized=True), str(tmp_path / "out")
    stream_append(spark, batches(tmp_path / "in"), SPEC, config, out, str(tmp_path / "cp"), 1).awaitTermination()
    stamps = rows(read_appended(spark, out).groupBy("_sdc_batched_at").count(), "count")
    assert stamps == [(1,), (2,)]


def test_idle_streams_get_no_load(spark, database, tmp_path):
    other = StreamSpec("other", SPEC.json_schema, ("id",))
    write_log(tmp_path / "in" / "b1", [schema(s, PROPS, ["id"]) for s in ("people", "other")] + [record(s, {"id": 1}) for s in ("people", "other")])
    write_log(tmp_path / "in" / "b2", [record("people", {"id": 2})])
    config = {"database": database, "denormalized": True}
    stream_load(spark, str(tmp_path / "in" / "*"), config, str(tmp_path / "cp"), 1, clock=lambda: day(1)).awaitTermination()
    assert LandingTable.find(spark, f"{database}.people").load_id == 2
    assert LandingTable.find(spark, f"{database}.{other.name}").load_id == 1


WIDE = {**PROPS, "home": {"type": "object", "properties": {"city": {"type": "string"}}}}
WIDER = {**PROPS, "age": {"type": "integer"}, "home": {"type": "object", "properties": {"city": {"type": "string"}, "zip": {"type": "string"}}}}


def test_schemas_grow_from_run_to_run(spark, database, tmp_path):
    config, source, checkpoint = {"database": database, "denormalized": True}, str(tmp_path / "in" / "*"), str(tmp_path / "cp")

    def run():
        stream_load(spark, source, config, checkpoint, 1, clock=lambda: day(1)).awaitTermination()

    write_log(tmp_path / "in" / "b1", [schema("people", WIDE, ["id"]), record("people", {"id": 1, "home": {"city": "a"}})])
    # a wider schema in the same run does not count yet
    write_log(tmp_path / "in" / "b2", [schema("people", WIDER, ["id"]), record("people", {"id": 2, "age": 5, "home": {"city": "b", "zip": "z"}})])
    run()
    table = f"{database}.people"
    assert "age" not in spark.table(table).columns
    write_log(tmp_path / "in" / "b3", [schema("people", WIDER, ["id"]), record("people", {"id": 3, "age": 6, "home": {"city": "c", "zip": "y"}})])
    run()
    write_log(tmp_path / "in" / "b4", [record("people", {"id": 4, "age": 7})])  # the last schema stays
    run()
    got = spark.table(table).selectExpr("id", "age", "home.city", "home.zip")
    assert rows(got) == [(1, None, "a", None), (2, None, "b", None), (3, 6, "c", "y"), (4, 7, None, None)]


def test_a_replayed_batch_is_read_with_the_schema_it_was_tried_with(spark, database, tmp_path):
    config, source, checkpoint = {"database": database, "denormalized": True}, str(tmp_path / "in" / "*"), str(tmp_path / "cp")
    write_log(tmp_path / "in" / "b1", [schema("people", PROPS, ["id"]), record("people", {"id": 1})])
    write_log(tmp_path / "in" / "b2", [schema("people", WIDER, ["id"]), record("people", {"id": 2, "age": 5})])

    def die(batch, results, bookmark):
        if batch == 1:
            raise RuntimeError("lost the driver")

    with pytest.raises(Exception, match="lost the driver"):
        stream_load(spark, source, config, checkpoint, 1, clock=lambda: day(1), on_commit=die).awaitTermination()
    spark.sql(f"DROP VIEW {database}.people")  # the table is lost too: both batches' rows have to be read alike again
    spark.sql(f"DROP TABLE {database}.people__v1")
    stream_load(spark, source, config, checkpoint, 1, clock=lambda: day(1)).awaitTermination()
    assert "age" not in spark.table(f"{database}.people").columns and rows(spark.table(f"{database}.people"), "id") == [(2,)]


def test_batches_bounded_in_bytes(spark, database, tmp_path):
    for n in range(6):
        write_log(tmp_path / "in" / f"b{n}", [schema("people", PROPS, ["id"])] + [record("people", {"id": n * 10 + i}) for i in range(10)])
    seen = []
    config = {"database": database, "denormalized": True, "batch_bytes": 2_000, "batch_size": 4}
    stream_load(spark, str(tmp_path / "in" / "*"), config, str(tmp_path / "cp"), clock=lambda: day(1),
                on_commit=lambda n, results, _: seen.append(results[0].rows)).awaitTermination()
    assert len(seen) > 1 and sum(seen) == 60
    from pyspark.sql import functions as F
    files = spark.table(f"{database}.people__v1").groupBy(F.input_file_name()).count()
    assert max(r["count"] for r in files.collect()) <= 4
    with pytest.raises(ValueError, match="not by both"):
        from sluiceway.sources import stream_lines
        stream_lines(spark, str(tmp_path / "in"), 1, 1)
