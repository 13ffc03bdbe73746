"""Every transport with every table shape and write mode: the same two runs, the same tables."""

import pytest
from pyspark.sql import functions as F

from sluiceway import load_messages, read_appended, stream_append, stream_load
from sluiceway.functions import StreamSpec

from .conftest import day, lines, record, rows, schema, state, write_log

WIDE = {
    "id": {"type": ["integer", "null"]}, "load_id": {"type": ["string", "null"]},
    "Col_3_datetime": {"format": "date-time", "type": ["string", "null"]}, "Col_5_float": {"type": ["number", "null"]},
}


def run_of(ids, load_id):
    body = {"Col_3_datetime": "2022-11-11T13:40:56.806208+00:00", "Col_5_float": 0.25}
    return [schema("wide", WIDE, ["id"]), *[record("wide", {"id": i, "load_id": load_id, **body}, "2022-11-11T20:40:56Z") for i in ids], state({"at": load_id})]


RUNS = [(range(5), "first"), (range(3, 8), "second")]
EXPECTED = {
    "append": [(i, "first") for i in range(5)] + [(i, "second") for i in range(3, 8)],
    "overwrite": [(i, "second") for i in range(3, 8)],
    "upsert": [(i, "first") for i in range(3)] + [(i, "second") for i in range(3, 8)],
}
SETTINGS = {"append": {}, "overwrite": {"overwrite": True}, "upsert": {"upsert": "w*"}}
SHAPES = [(True, "append"), (True, "overwrite"), (True, "upsert"), (False, "append"), (False, "overwrite")]


@pytest.mark.parametrize("denormalized, mode", SHAPES)
@pytest.mark.parametrize("transport", ["batch_job", "lake_stage", "stream_load"])
def test_pattern(spark, database, tmp_path, transport, denormalized, mode):
    settings = {"database": database, "denormalized": denormalized, **SETTINGS[mode]}
    for n, (ids, load_id) in enumerate(RUNS, 1):
        messages = run_of(ids, load_id)
        if transport == "stream_load":  # a run is a query with a checkpoint of its own, here of two batches
            write_log(tmp_path / f"in{n}" / "b1", messages[:3])
            write_log(tmp_path / f"in{n}" / "b2", messages[3:])
            stream_load(spark, str(tmp_path / f"in{n}" / "*"), settings, str(tmp_path / f"cp{n}"), 1, clock=lambda: day(n)).awaitTermination()
        else:
            load_messages(spark, lines(spark, messages), {**settings, "method": transport, "lake_root": str(tmp_path)}, day(n))
    df = spark.table(f"{database}.wide")
    if not denormalized:
        df = df.selectExpr("variant_get(data, '$.id', 'bigint') AS id", "variant_get(data, '$.load_id', 'string') AS load_id")
    assert rows(df, "id", "load_id") == sorted(EXPECTED[mode], key=repr)


@pytest.mark.parametrize("denormalized", [True, False])
def test_append_stream(spark, tmp_path, denormalized):
    for n, (ids, load_id) in enumerate(RUNS, 1):
        write_log(tmp_path / "in" / f"b{n}", run_of(ids, load_id))
    spec = StreamSpec("wide", {"properties": WIDE}, ("id",))
    out = str(tmp_path / "out")
    stream_append(spark, str(tmp_path / "in" / "*"), spec, {"denormalized": denormalized}, out, str(tmp_path / "cp"), 1, clock=lambda: day(1)).awaitTermination()
    df = read_appended(spark, out)
    key = "id" if denormalized else "variant_get(data, '$.id', 'bigint')"
    assert rows(df.select(F.expr(key))) == [(i,) for i in sorted([*range(5), *range(3, 8)])]
