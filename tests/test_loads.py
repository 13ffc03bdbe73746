import datetime as dt
import glob
import gzip
import json
import os
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluiceway import LoadConfig, LoadError, load_messages, read_between, read_state
from sluiceway.plans import LandingTable, cluster_layout, compact, expire_partitions, expire_staging, partition_column, stage_to_lake, staging_name
from sluiceway.plans.loads import clustering, load_stream
from sluiceway.plans.loads import load as load_frame
from sluiceway.functions import StreamSpec

from .conftest import day, lines, plan, record, rows, schema, state, write_log

ROOT = Path(__file__).resolve().parent.parent

PEOPLE = {"id": {"type": ["integer", "null"]}, "name": {"type": ["string", "null"]}}


def people(*pairs, extracted=None):
    return [schema("people", PEOPLE, ["id"]), *[record("people", {"id": i, "name": n}, extracted) for i, n in pairs]]


def load(spark, database, messages, as_of=day(1), **settings):
    source = messages if not isinstance(messages, list) else lines(spark, messages)
    return load_messages(spark, source, {"database": database, "denormalized": True, **settings}, as_of)


def names(spark, database, table="people"):
    return rows(spark.table(f"{database}.{table}"), "id", "name")


def test_append_adds_each_time(spark, database):
    for n in (1, 2):
        [result], bookmark = load(spark, database, people((1, "a"), (2, "b")) + [state({"n": n})], day(n))
        assert (result.mode, result.rows, result.rejected, result.load_id) == ("append", 2, 0, n)
        assert json.loads(bookmark) == {"n": n}
    assert names(spark, database) == [(1, "a"), (1, "a"), (2, "b"), (2, "b")]


def test_overwrite_replaces_rows_and_schema_and_keeps_the_layout(spark, database):
    load(spark, database, people((1, "a")), day(1))
    new = [schema("people", {"id": {"type": "string"}}), record("people", {"id": "x"})]
    load(spark, database, new, day(2), overwrite="peo*")
    assert rows(spark.table(f"{database}.people"), "id") == [("x",)]
    table = LandingTable.find(spark, f"{database}.people")
    assert table.partitions(spark) == ["2024-01-01"]
    assert table.retired and spark.catalog.tableExists(table.retired)  # readers of the old version can finish
    load(spark, database, new, day(3), overwrite=True)
    assert not spark.catalog.tableExists(table.retired)


def test_upsert_and_dedupe(spark, database):
    load(spark, database, people((1, "a"), (2, "b")), day(1), upsert=True)
    late = people((2, "first"), extracted="2024-01-01T00:00:00Z") + [
        record("people", {"id": 2, "name": "second"}, "2024-01-03T00:00:00Z"),
        record("people", {"id": 3, "name": "tie one"}, "2024-01-03T00:00:00Z"),
        record("people", {"id": 3, "name": "tie two"}, "2024-01-03T00:00:00Z"),
    ]
    load(spark, database, late, day(2), upsert=True, dedupe_before_upsert="people")
    assert names(spark, database) == [(1, "a"), (2, "second"), (3, "tie two")]


def partition_files(spark, table):
    """Files of each partition, by its value."""
    found = {}
    for path in spark.table(f"{table}__v1").inputFiles():
        found.setdefault(path.split("_sdc_batched_month=")[1].split("/")[0], set()).add(path)
    return found


def test_upsert_rewrites_only_touched_partitions(spark, database):
    for month, pair in ((1, (1, "a")), (2, (2, "b")), (3, (3, "c"))):
        load(spark, database, people(pair), dt.datetime(2024, month, 5, tzinfo=dt.timezone.utc), upsert=True)
    before = partition_files(spark, f"{database}.people")
    load(spark, database, people((2, "B"), (4, "d")), dt.datetime(2024, 4, 5, tzinfo=dt.timezone.utc), upsert=True)
    after = partition_files(spark, f"{database}.people")
    assert {p: before[p] for p in ("2024-01-01", "2024-03-01")} == {p: after[p] for p in ("2024-01-01", "2024-03-01")}
    assert sorted(after) == ["2024-01-01", "2024-03-01", "2024-04-01"]  # its only row has moved
    assert names(spark, database) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    load(spark, database, people((5, "e")), dt.datetime(2024, 4, 6, tzinfo=dt.timezone.utc), upsert=True)
    added = partition_files(spark, f"{database}.people")
    assert after["2024-04-01"] < added["2024-04-01"]  # new keys are added, nothing is rewritten
    assert names(spark, database)[-1] == (5, "e")


def test_upsert_keeps_target_only_columns(spark, database):
    load(spark, database, people((1, "a"), (2, "b")), day(1), upsert=True)
    slim = [schema("people", {"id": PEOPLE["id"]}, ["id"]), record("people", {"id": 1}), record("people", {"id": 3})]
    load(spark, database, slim, day(2), upsert=True)
    assert names(spark, database) == [(1, "a"), (2, "b"), (3, None)]


def test_merge_rewrites_only_touched_partitions_however_many(spark, database):
    for n in range(1, 8):
        load(spark, database, people((n, "a")), dt.datetime(2024, n, 1, tzinfo=dt.timezone.utc), upsert=True)
    later = people(*[(n, "A") for n in range(1, 7)], (9, "z"))
    load(spark, database, later, dt.datetime(2024, 9, 1, tzinfo=dt.timezone.utc), upsert=True)
    assert LandingTable.find(spark, f"{database}.people").partitions(spark) == ["2024-07-01", "2024-09-01"]
    assert names(spark, database) == [*[(n, "A") for n in range(1, 7)], (7, "a"), (9, "z")]


def test_a_merge_scans_the_keys_once_and_joins_three_times(spark, database, monkeypatch):
    from sluiceway.operators import merge as merging
    from sluiceway.plans import tables

    seen = []
    for module, name in ((tables, "key_matches"), (tables, "upsert")):
        def spied(*args, _do=getattr(merging, name), **more):
            seen.append(plan(_do(*args, **more)))
            return _do(*args, **more)
        monkeypatch.setattr(module, name, spied)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(1000).select(F.col("id"), F.lit("a").alias("name"), F.lit("x").alias("wide"))
        load_frame(df, f"{database}.t")
        load_frame(df.filter("id BETWEEN 100 AND 200").withColumn("name", F.lit("b")), f"{database}.t", "upsert", keys=["id"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    match, merged = seen
    assert match.count("Join ") + merged.count("Join ") <= 3
    scans = [line for line in match.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "GreaterThanOrEqual(id,100)" in scans[0] and scans[0].endswith("ReadSchema: struct<id:bigint,_load_id:bigint>")
    assert sum("__v1" in line for line in merged.splitlines() if "FileScan" in line) == 1  # the touched partitions
    assert rows(spark.table(f"{database}.t").groupBy("name").count()) == [("a", 899), ("b", 101)]


def test_a_hot_key_that_matches_nothing_is_folded_before_the_update_join(spark):
    from sluiceway.operators.merge import one_per_key
    text = plan(one_per_key(spark.range(10).select(F.lit(1).alias("k"), F.col("id").alias("v")), ["k"]))
    assert text.index("Aggregate") < text.index("Exchange") < text.rindex("Aggregate")


def test_a_broken_upsert_is_finished(spark, database, monkeypatch):
    load(spark, database, people((1, "a"), (2, "b"), (None, "n")), dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc), upsert=True)
    name, source = f"{database}.people", spark.createDataFrame([(2, "B"), (3, "c"), (None, "m")], "id BIGINT, name STRING")
    source.write.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/{database}-source")
    source = spark.read.parquet(f"{spark.conf.get('spark.checkpoint.dir')}/{database}-source")
    staged = source.withColumn("_sdc_batched_at", F.lit(day(40 - 9)).cast("timestamp"))
    table = LandingTable.find(spark, name).merge(spark, staged, ["id"])
    monkeypatch.setattr(LandingTable, "drop_partitions", lambda *_: (_ for _ in ()).throw(OSError("the driver died")))
    with pytest.raises(OSError):
        table.publish(spark)
    monkeypatch.undo()
    found = LandingTable.find(spark, name).begin(spark)
    assert found.load_id == 2 and not found.pending
    assert names(spark, database) == [(1, "a"), (2, "B"), (3, "c"), (None, "m"), (None, "n")]
    assert LandingTable.find(spark, name).begin(spark).load_id == 2


def test_two_rows_for_one_target_row_stop_the_load(spark, database):
    load(spark, database, people((1, "a")), day(1), upsert=True)
    clash = people((1, "x"), (1, "y"), (2, "n"), (5, "twice"), (5, "new"))
    with pytest.raises(LoadError, match="several records update one row"):
        load(spark, database, clash, day(2), upsert=True)
    assert names(spark, database) == [(1, "a")]
    load(spark, database, clash, day(3), upsert=True, fail_fast=False)
    assert names(spark, database) == [(1, "a"), (2, "n"), (5, "new"), (5, "twice")]
    kept = spark.table(f"{database}.quarantine")
    assert sorted(json.loads(r.raw)["name"] for r in kept.collect()) == ["x", "y"]


BAD = [record("people", {"id": "not a number"}), record("people", {"name": "no key"})]


def test_bad_rows_stop_the_load_before_anything_shows(spark, database, tmp_path):
    path = str(tmp_path / "state")
    load(spark, database, people((1, "a")) + [state({"n": 1})], day(1), state_path=path)
    for mode in ({}, {"upsert": True}, {"overwrite": True}, {"method": "lake_stage", "lake_root": str(tmp_path / "lake")}, {"clustering_fields": ("id",)}):
        with pytest.raises(LoadError, match="2 of 3 records were rejected"):
            load(spark, database, people((2, "b")) + BAD + [state({"n": 2})], day(2), state_path=path, **mode)
        assert names(spark, database) == [(1, "a")]
        assert json.loads(read_state(spark, path)) == {"n": 1}
    load(spark, database, people((3, "c")) + [state({"n": 3})], day(3), state_path=path)
    assert names(spark, database) == [(1, "a"), (3, "c")]  # nothing of the failed loads is left
    assert json.loads(read_state(spark, path)) == {"n": 3}


@pytest.mark.parametrize("settings", [{}, {"upsert": True}, {"overwrite": True}, {"denormalized": False}])
def test_bad_rows_are_kept_without_fail_fast(spark, database, settings):
    [result], _ = load(spark, database, people((1, "a")) + BAD + ["garbage", record("nobody", {"x": 1})], fail_fast=False, **settings)
    fixed = settings == {"denormalized": False}  # any value fits there, only the key is checked
    assert (result.rows, result.rejected) == ((2, 1) if fixed else (1, 2))
    kept = rows(spark.table(f"{database}.quarantine"), "stream", "reason")
    assert ("people", "a key property is missing") in kept
    assert [r for r in kept if r[0] == "unassigned"] == [("unassigned", "a record without a schema"), ("unassigned", "not a message")]
    assert len(kept) == (3 if fixed else 4)


@pytest.mark.parametrize("stray", ["garbage", "[1]", json.dumps(record("nobody", {"x": 1}))])
@pytest.mark.parametrize("streams", [1, 2])
def test_stray_lines_stop_the_load(spark, database, stray, streams):
    more = [schema("other", PEOPLE, ["id"])][: streams - 1]
    with pytest.raises(LoadError, match="1 lines are no message, or records of a stream without a schema"):
        load(spark, database, people((1, "a")) + more + [stray, ""])
    assert not spark.catalog.tableExists(f"{database}.people") or names(spark, database) == []


def test_many_streams_are_split_once(spark, database):
    streams = [f"S-{i}" for i in range(5)]
    messages = [m for s in streams for m in (schema(s, PEOPLE, ["id"]), record(s, {"id": 1, "name": s}))]
    split = load(spark, database, messages, day(2))
    assert [r.rows for r in split[0]] == [1] * 5
    assert names(spark, database, "s_3") == [(1, "S-3")]


def test_a_dead_attempt_is_written_over(spark, database):
    load(spark, database, people((1, "a")), day(1))
    table = LandingTable.find(spark, f"{database}.people")
    table.append(spark, spark.table(table.name))  # written, never published
    assert names(spark, database) == [(1, "a")]
    load(spark, database, people((2, "b")), dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc))
    assert names(spark, database) == [(1, "a"), (2, "b")]
    assert LandingTable.find(spark, f"{database}.people").partitions(spark) == ["2024-01-01", "2024-05-01"]
    assert spark.table(f"{database}.people__v1").count() == 2


def test_fixed_shape_with_view(spark, database):
    messages = [schema("Events", {"UserId": {"type": "integer"}, "at": {"type": "string", "format": "date-time"}}, ["UserId"]),
                record("Events", {"UserId": 5, "at": "2024-01-01T00:00:00Z", "free": [1]})]
    load(spark, database, messages, denormalized=False, generate_view=True, column_name_transforms={"snake_case": True})
    fixed = spark.table(f"{database}.events")
    assert fixed.columns[0] == "data" and len(fixed.columns) == 7
    assert rows(spark.table(f"{database}.events_view")) == [(5, dt.datetime(2024, 1, 1))]
    assert "json" not in plan(spark.table(f"{database}.events_view").select("user_id")).lower().replace("parse_json", "")


def test_evolution_and_comments(spark, database):
    load(spark, database, people((1, "a")), day(1))
    wider = [schema("people", {**PEOPLE, "age": {"type": "integer"}}, ["id"]), record("people", {"id": 2, "age": 7})]
    load(spark, database, wider, day(2))
    df = spark.table(f"{database}.people")
    assert df.columns[-1] == "age" and rows(df, "id", "age") == [(1, None), (2, 7)]
    text = "\n".join(r.data_type or "" for r in spark.sql(f"DESCRIBE EXTENDED {database}.people").collect())
    assert '"age"' in text and "Shape: denormalized" in text


def test_maps_alias_filter_and_flatten(spark, database):
    messages = [schema("db-people", {**PEOPLE, "home": {"type": "object", "properties": {"city": {"type": "string"}}}}, ["id"]),
                record("db-people", {"id": 1, "name": "a", "home": {"city": "x"}}), record("db-people", {"id": 2, "name": "b"})]
    maps = {"db-people": {"__alias__": "people", "__filter__": "id > 0", "name": "upper(name)", "who": "config.tag"}}
    settings = {"stream_maps": maps, "stream_map_config": {"tag": "t"}, "flattening_enabled": True, "flattening_max_depth": 1}
    load(spark, database, messages, upsert=True, **settings)
    df = spark.table(f"{database}.people")
    assert rows(df, "id", "name", "home__city", "who") == [(1, "A", "x", "t"), (2, "B", None, "t")]
    assert rows(df, "_sdc_batched_at")[0] == (dt.datetime(2024, 1, 1),)
    load(spark, database, messages, denormalized=False, **{**settings, "stream_maps": {"db-people": {"__alias__": "fixed"}}})
    assert rows(spark.table(f"{database}.fixed").select(F.to_json("data"))) == [
        ('{"home__city":"x","id":1,"name":"a"}',), ('{"home__city":null,"id":2,"name":"b"}',)]
    results, _ = load(spark, database, messages, stream_maps={"db-people": None})
    assert results == []


def test_given_specs_skip_the_lookup(spark, database):
    spec = StreamSpec("people", {"properties": PEOPLE}, ("id",))
    [result], bookmark = load_messages(
        spark, lines(spark, [record("people", {"id": 1}), state({"n": 1})]), {"database": database}, day(1), {"people": spec})
    assert result.rows == 1 and bookmark == '{"n":1}'
    again = load_stream(spark, lines(spark, [record("people", {"id": 2})]), spec, {"database": database}, day(2))
    assert again.load_id == 2


# ---- lake -----------------------------------------------------------------


def test_lake_files_and_folders(spark, database, tmp_path):
    root = str(tmp_path / "lake")
    for settings in ({}, {"denormalized": False, "database": database}):
        as_of = day(5) if settings else day(4)
        load(spark, database, people((1, "a"), extracted="2023-12-31T23:00:00Z"), as_of, method="lake_stage", lake_root=root, **settings) if not settings else None
    [path] = glob.glob(f"{root}/{database}/people/extracted_date=2023-12-31/batch_id=*/*.json.gz")
    body = json.loads(gzip.open(path, "rt").read())
    assert body["id"] == 1 and body["_sdc_batched_at"].startswith("2024-01-04T00:00:00.000000")
    assert names(spark, database) == [(1, "a")]


def test_lake_round_trip_of_the_fixed_shape(spark, database, tmp_path):
    messages = [schema("e", {"a": {"type": "integer"}}), record("e", {"a": 1.50, "b": {"c": [None, "é"]}}, "2024-01-01T00:00:00.123456Z")]
    load(spark, database, messages, denormalized=False, method="lake_stage", lake_root=str(tmp_path))
    got = spark.table(f"{database}.e").select(F.to_json("data"), "_sdc_extracted_at").first()
    assert tuple(got) == ('{"a":1.5,"b":{"c":[null,"é"]}}', dt.datetime(2024, 1, 1, 0, 0, 0, 123456))


def test_a_staged_batch_is_never_written_over(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "id INT")
    stage_to_lake(df, str(tmp_path), "s", "b1", day(1))
    with pytest.raises(FileExistsError, match="b1"):
        stage_to_lake(df, str(tmp_path), "s", "b1", day(2))
    stage_to_lake(df, str(tmp_path), "s", "b2", day(2))


def test_a_refused_batch_leaves_the_lake_and_can_be_retried(spark, database, tmp_path):
    settings = {"method": "lake_stage", "lake_root": str(tmp_path)}
    with pytest.raises(LoadError, match="rejected"):
        load(spark, database, people((1, "a")) + BAD, day(2), **settings)
    assert glob.glob(f"{tmp_path}/{database}/people/extracted_date=*/batch_id=*") == []
    load(spark, database, people((1, "a")), day(2), **settings)
    assert names(spark, database) == [(1, "a")]


def test_compaction_folds_the_files_of_a_period(spark, database):
    for n in (1, 2, 3):
        load(spark, database, people((n, "x")), day(n))
    load(spark, database, people((4, "feb")), dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    name = f"{database}.people"
    before = partition_files(spark, name)
    assert compact(spark, name) == 1 and names(spark, database) == [(1, "x"), (2, "x"), (3, "x"), (4, "feb")]
    after = partition_files(spark, name)
    assert len(before["2024-01-01"]) == 3 and len(after["2024-01-01"]) == 1 and before["2024-02-01"] == after["2024-02-01"]
    load(spark, database, people((5, "y")), dt.datetime(2024, 2, 2, tzinfo=dt.timezone.utc))
    assert names(spark, database) == [(1, "x"), (2, "x"), (3, "x"), (4, "feb"), (5, "y")]
    assert compact(spark, name, at_least=4) == 0 and len(names(spark, database)) == 5


def test_a_frame_of_many_periods_makes_few_files(spark, database):
    at = F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 5 * 86400 * 31)
    df = spark.range(0, 4000, 1, 8).select(F.col("id"), at.alias("_sdc_batched_at"))
    load_frame(df, f"{database}.many")
    assert len(spark.table(f"{database}.many__v1").inputFiles()) <= 10
    assert spark.table(f"{database}.many").count() == 4000


def test_batch_files_of_another_format_are_refused(spark, database):
    batch = {"type": "BATCH", "stream": "people", "encoding": {"format": "avro"}, "manifest": ["x"]}
    with pytest.raises(ValueError, match="format avro"):
        load(spark, database, people() + [batch])


def test_settings_without_effect_are_told():
    with pytest.warns(UserWarning, match="timeout"):
        LoadConfig.of({"timeout": 600})


def test_staging_of_a_backfill_outlives_newer_loads(spark, database, tmp_path):
    from sluiceway.plans.loads import _staging_path
    path = _staging_path(spark, LoadConfig(staging_root=str(tmp_path)), "backfill")
    spark.range(1).write.parquet(path)
    load(spark, database, people((1, "a")), dt.datetime(2040, 1, 1, tzinfo=dt.timezone.utc), staging_root=str(tmp_path))
    assert [p.name for p in tmp_path.iterdir()] == [path.rsplit("/", 1)[1]]


# ---- layout ---------------------------------------------------------------


def test_clustering_choice():
    spec = StreamSpec("s", {}, ("TapId",))
    base = LoadConfig(denormalized=True, column_name_transforms={"snake_case": True})
    assert clustering(spec, base) == ()
    assert clustering(spec, replace(base, cluster_on_key_properties=True)) == ("tap_id",)
    five = ("tenant_id", "updated_at", "id", "region", "ignored")
    assert clustering(spec, replace(base, cluster_on_key_properties=True, clustering_fields=five)) == five


def test_clustered_files_cover_narrow_ranges_even_with_a_hot_value(spark, tmp_path):
    keys = F.when(F.col("id") < 3000, F.lit(500)).otherwise(F.col("id") % 1000)
    df = spark.range(9000, numPartitions=6).select(keys.alias("k"), F.col("id").alias("v"))
    cluster_layout(df, ["k"], 6).write.parquet(str(tmp_path / "c"))
    out = spark.read.parquet(str(tmp_path / "c"))
    assert rows(out.agg(F.count("*"), F.sum("v"))) == rows(df.agg(F.count("*"), F.sum("v")))
    files = out.groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"), F.count("*").alias("n")).collect()
    assert len(files) >= 5 and max(r.n for r in files) < 3000  # the hot value is spread
    spans = sorted((r.lo, r.hi) for r in files)
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("grain, expected", [("hour", "2024-03-05 07:00:00"), ("day", "2024-03-05"), ("month", "2024-03-01"), ("year", "2024-01-01")])
def test_grains(spark, database, grain, expected):
    at = dt.datetime(2024, 3, 5, 7, 8, tzinfo=dt.timezone.utc)
    load(spark, database, people((1, "a")), at, partition_granularity=grain, upsert=True)
    load(spark, database, people((1, "b")), at + dt.timedelta(minutes=1), partition_granularity=grain, upsert=True)
    table = LandingTable.find(spark, f"{database}.people")
    assert table.partitions(spark) == [expected]
    assert names(spark, database) == [(1, "b")]
    assert read_between(spark, table.name, at, at + dt.timedelta(hours=1)).count() == 1
    assert read_between(spark, table.name, at + dt.timedelta(hours=1), at + dt.timedelta(hours=2)).count() == 0


def test_unknown_grain():
    with pytest.raises(ValueError, match="granularity"):
        partition_column("week")


def test_expiry_of_partitions(spark, database):
    for n in (1, 10, 20):
        load(spark, database, people((n, "x")), day(n), partition_granularity="day")
    assert expire_partitions(spark, f"{database}.people", 13, day(22)) == ["2024-01-01"]
    assert names(spark, database) == [(10, "x"), (20, "x")]
    load(spark, database, people((30, "x")), day(30), partition_granularity="day", partition_expiration_days=11)
    assert names(spark, database) == [(20, "x"), (30, "x")]
    assert expire_partitions(spark, f"{database}.absent", 1, day(1)) == []


def test_staging_names_and_expiry(spark, tmp_path):
    at = dt.datetime(2026, 7, 5, 2, 5, 30, tzinfo=dt.timezone.utc)
    assert staging_name("orders_stream", at, "tmp-{table_name}-{timestamp}-{uuid}", "abc123") == "tmp_orders_stream_20260705020530_abc123"
    for made in (day(1), day(8), day(9)):
        (tmp_path / staging_name("t", made)).mkdir()
    (tmp_path / "something_else").mkdir()
    assert len(expire_staging(spark, str(tmp_path), day(15))) == 1
    assert len(expire_staging(spark, str(tmp_path), day(15), hours=24)) == 2
    assert [p.name for p in tmp_path.iterdir()] == ["something_else"]
    assert expire_staging(spark, str(tmp_path / "absent"), day(1)) == []


def test_finished_loads_leave_no_staging(spark, database, tmp_path):
    load(spark, database, people((1, "a")), upsert=True, dedupe_before_upsert=True, staging_root=str(tmp_path))
    load(spark, database, people((2, "b")) + [schema("other", PEOPLE, ["id"])], upsert=True, staging_root=str(tmp_path))
    assert list(tmp_path.iterdir()) == []


def test_tables_of_others_are_left_alone(spark, database):
    spark.sql(f"CREATE TABLE {database}.people (id INT) USING parquet")
    with pytest.raises(ValueError, match="not created by a load"):
        load(spark, database, people((1, "a")))


def test_batch_files_are_part_of_the_log(spark, database, tmp_path):
    path = tmp_path / "b.jsonl.gz"
    with gzip.open(path, "wt") as out:
        out.write('{"id": 1, "name": "a"}\n\n{"id": 2.0, "name": "b"}\n')
    batch = {"type": "BATCH", "stream": "people", "encoding": {"format": "jsonl", "compression": "gzip"}, "manifest": [str(path)]}
    [result], _ = load(spark, database, people((3, "c")) + [batch])
    assert result.rows == 3 and names(spark, database) == [(1, "a"), (2, "b"), (3, "c")]
    path.write_bytes(gzip.compress(b'{"id": "x"}\n{broken\n'))
    with pytest.raises(LoadError):
        load(spark, database, people((4, "d")) + [batch], day(2))
    assert len(names(spark, database)) == 3


def test_parquet_batch_files(spark, database, tmp_path):
    def batch(kind, *frames):
        for i, df in enumerate(frames):
            df.coalesce(1).write.parquet(str(tmp_path / kind / str(i)))
        files = [f for i in range(len(frames)) for f in spark.read.parquet(str(tmp_path / kind / str(i))).inputFiles()]
        return {"type": "BATCH", "stream": "people", "encoding": {"format": "parquet"}, "manifest": files}

    small = spark.createDataFrame([(1, "a")], "id INT, name STRING")
    wide = spark.createDataFrame([(2, "b", 5)], "id BIGINT, name STRING, more INT")
    text = spark.createDataFrame([("3", 7), ("x", 8)], "id STRING, name INT")
    [result], _ = load(spark, database, people((9, "log")) + [batch("p", small, wide, text)], fail_fast=False)
    assert (result.rows, result.rejected) == (4, 1)
    assert names(spark, database) == [(1, "a"), (2, "b"), (3, "7"), (9, "log")]
    assert [json.loads(r.raw)["record"] for r in spark.table(f"{database}.quarantine").collect()] == [{"id": "x", "name": 8}]
    load(spark, database, [schema("loose", PEOPLE, ["id"]), {**batch("r", small, wide), "stream": "loose"}], denormalized=False)
    assert rows(spark.table(f"{database}.loose").select(F.to_json("data"))) == [('{"id":1,"name":"a"}',), ('{"id":2,"more":5,"name":"b"}',)]


def test_a_hundred_thousand_batch_files_are_listed_by_row(spark):
    from sluiceway.sources.files import _chunks, batch_files
    names_of = F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.concat(F.lit('"f'), (F.col("id") * 100 + i).cast("string"), F.lit('"')))
    line = F.concat(F.lit('{"type":"BATCH","stream":"s","encoding":{"format":"jsonl"},"manifest":['), F.array_join(names_of, ","), F.lit("]}"))
    found = batch_files(spark.range(1000).select(line.alias("payload")))
    assert len(found["s"]["jsonl"]) == 100_000 and len(_chunks(found["s"]["jsonl"])) == 10


def nested(value, day_=None, **fields):
    kinds = {n: {"type": k} for n, k in fields.items()}
    shape = {"type": "object", "properties": kinds}
    return [schema("people", {"id": {"type": "integer"}, "home": shape, "stays": {"type": "array", "items": shape}}, ["id"]),
            record("people", {"id": 2, "home": value, "stays": [value]})]


@pytest.mark.parametrize("mode", [{}, {"upsert": True}, {"clustering_fields": ("id",)}, {"method": "lake_stage"}])
def test_nested_fields_are_added(spark, database, tmp_path, mode):
    mode = {**mode, **({"lake_root": str(tmp_path)} if "method" in mode else {})}
    load(spark, database, nested({"city": "a"}, city="string"), day(1), **mode)
    load(spark, database, nested({"city": "b", "street": "s"}, city="string", street="string"), dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc), **mode)
    load(spark, database, nested({"floor": 3}, floor="integer"), dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc), **mode)
    got = rows(spark.table(f"{database}.people").selectExpr("home.city", "home.street", "home.floor", "stays[0].street", "stays[0].floor"))
    last = (None, None, 3, None, 3)
    if "upsert" in mode:  # a record is updated whole
        assert got == [last]
    else:
        assert got == sorted([("a", None, None, None, None), ("b", "s", None, "s", None), last], key=repr)


def test_a_load_that_fails_leaves_the_table_readable(spark, database):
    load(spark, database, nested({"city": "a"}, city="string"), day(1))
    wider = nested({"city": "b", "street": "s"}, city="string", street="string")
    table = LandingTable.find(spark, f"{database}.people")
    from sluiceway.functions import to_struct
    table.evolve(spark, to_struct(wider[0]["schema"]))  # and then the driver dies
    assert rows(spark.table(f"{database}.people"), "id") == [(2,)]


def test_quoted_scalars(spark, database):
    kinds = {"id": {"type": "integer"}, "n": {"type": "number"}, "b": {"type": "boolean"}, "t": {"type": "string"},
             "in": {"type": "object", "properties": {"n": {"type": "number"}, "t": {"type": "integer"}}}}
    def one(**more):
        return record("q", {"id": "1", "n": "2.5", "b": "true", "t": "5", **more})
    fits = [one(), one(id="-7", n="-0.25"), one(n="15"), one(**{"in": {"n": "3"}}), one(id=1, n=1e3, t=' "n":"7" ')]
    [result], _ = load(spark, database, [schema("q", kinds), *fits])
    got = rows(spark.table(f"{database}.q").selectExpr("id", "n", "b", "t", "`in`.n"))
    assert got == sorted([(1, 2.5, True, "5", None), (-7, -0.25, True, "5", None), (1, 15.0, True, "5", None), (1, 2.5, True, "5", 3.0), (1, 1000.0, True, ' "n":"7" ', None)], key=repr)
    for bad in (one(id="01"), one(id="1.5"), one(id=" 1"), one(n="2.50"), one(n="1e3"), one(b="TRUE"), one(id="1" * 19), one(n="0.1234567890123456"), one(**{"in": {"t": "5"}})):
        with pytest.raises(LoadError, match="rejected"):
            load(spark, database, [schema("q", kinds), bad], day(2))


def test_a_log_is_parsed_once_whatever_it_holds(spark, database):
    """Good rows, rejects, strays and bookmarks leave one pass over the lines."""
    seen = spark.sparkContext.accumulator(0)
    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch
    messages = [record("people", {"id": 1})] + BAD + ["garbage", record("nobody", {"x": 1}), state({"n": 1}), state({"n": 2})]
    source = lines(spark, messages).mapInArrow(counted, "payload STRING")
    spec = StreamSpec("people", {"properties": PEOPLE}, ("id",))
    for n, mode in enumerate(({}, {"upsert": True}, {"upsert": True, "dedupe_before_upsert": True}, {"overwrite": True}, {"denormalized": False, "overwrite": True}), 1):
        settings = {"database": f"{database}", "denormalized": True, "fail_fast": False, **mode}
        seen.value = 0
        [result], bookmark = load_messages(spark, source, settings, day(n), {"people": spec})
        assert seen.value == len(messages) and json.loads(bookmark) == {"n": 2}
        assert result.rejected == (1 if settings["denormalized"] is False else 2)
    assert spark.table(f"{database}.quarantine").count() == 4 * 4 + 3


def test_counts_are_exact_after_a_retried_task(tmp_path):
    """A task that wrote its rows and died is run again; its rejects count once."""
    import subprocess
    import sys
    program = f"""
import datetime as dt, json, sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession
from sluiceway import load_messages
from sluiceway.functions import StreamSpec
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.warehouse.dir", {str(tmp_path / 'w')!r}).config("spark.checkpoint.dir", {str(tmp_path / 's')!r}).getOrCreate())
def dying(batches):
    yield from batches
    if TaskContext.get().attemptNumber() == 0:
        raise OSError("lost")
lines = [json.dumps({{"type": "RECORD", "stream": "p", "record": {{"id": i if i % 3 else "x"}}}}) for i in range(30)]
rows = spark.createDataFrame([(line,) for line in lines], "payload STRING").repartition(2).mapInArrow(dying, "payload STRING")
spec = StreamSpec("p", {{"properties": {{"id": {{"type": "integer"}}}}}}, ("id",))
[r], _ = load_messages(spark, rows, {{"denormalized": True, "fail_fast": False}}, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), {{"p": spec}})
print("COUNTS", r.rows, r.rejected, spark.table("default.p").count(), spark.table("default.quarantine").count())
"""
    done = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": str(ROOT)})
    assert "COUNTS 20 10 20 10" in done.stdout, done.stderr[-2000:]


def test_a_repeated_load_adds_nothing(spark, database, tmp_path):
    log = write_log(tmp_path / "log", people((1, "a")) + [schema("other", PEOPLE, ["id"]), record("other", {"id": 5}), state({"n": 1})])
    settings = {"database": database, "denormalized": True, "state_path": str(tmp_path / "state")}
    load_messages(spark, log, settings, day(1))
    results, bookmark = load_messages(spark, log, settings, day(2))
    assert [(r.mode, r.rows) for r in results] == [("loaded before", 0)] * 2 and json.loads(bookmark) == {"n": 1}
    assert names(spark, database) == [(1, "a")] and names(spark, database, "other") == [(5, None)]
    load_messages(spark, log, {**settings, "load_again": True}, day(3))
    assert names(spark, database) == [(1, "a"), (1, "a")]
    changed = write_log(tmp_path / "log", people((2, "b")) + [state({"n": 2})])
    load_messages(spark, changed, settings, day(4))
    assert names(spark, database) == [(1, "a"), (1, "a"), (2, "b")]


def test_only_the_tables_that_lack_a_log_take_it_in(spark, database, tmp_path, monkeypatch):
    from sluiceway.plans import loads
    log = write_log(tmp_path / "log", people((1, "a")) + [schema("other", PEOPLE, ["id"]), record("other", {"id": 5})])
    settings = {"database": database, "denormalized": True, "concurrent_streams": 1}
    show = loads._StreamLoad.show
    monkeypatch.setattr(loads._StreamLoad, "show", lambda self: show(self) if self.table_id == "people" else (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        load_messages(spark, log, settings, day(1))
    monkeypatch.undo()
    load_messages(spark, log, settings, day(2))
    assert names(spark, database) == [(1, "a")] and names(spark, database, "other") == [(5, None)]


def test_upserts_go_through_the_lake(spark, database, tmp_path):
    settings = {"method": "lake_stage", "lake_root": str(tmp_path), "upsert": True}
    load(spark, database, people((1, "a"), (2, "b")), day(1), **settings)
    load(spark, database, people((2, "first"), (2, "second"), (3, "c")), day(2), dedupe_before_upsert=True, **settings)
    assert names(spark, database) == [(1, "a"), (2, "second"), (3, "c")]
    assert len(glob.glob(f"{tmp_path}/{database}/people/extracted_date=*/batch_id=*")) == 2


def test_any_failure_takes_the_batch_out_of_the_lake(spark, database, tmp_path, monkeypatch):
    settings = {"method": "lake_stage", "lake_root": str(tmp_path)}
    monkeypatch.setattr(LandingTable, "append", lambda *_: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        load(spark, database, people((1, "a")), day(1), **settings)
    monkeypatch.undo()
    load(spark, database, people((1, "a")), day(1), **settings)
    assert names(spark, database) == [(1, "a")]


def test_a_date_with_many_rows_makes_several_files_of_bounded_bytes(spark, tmp_path, monkeypatch):
    from sluiceway.plans import lake
    monkeypatch.setattr(lake, "FILE_BYTES", 1 << 20)
    stamped = F.timestamp_seconds(F.lit(1704067200) + F.when(F.col("id") % 3 == 0, F.col("id") % 9 * 86400).otherwise(0))
    df = spark.range(0, 60_000, 1, 3).select("id", F.repeat(F.lit("x"), 40).alias("t"), stamped.alias("_sdc_extracted_at"))
    for stream, rows_ in (("many", df), ("one", df.withColumn("_sdc_extracted_at", F.lit(day(1))))):
        rows_.write.parquet(str(tmp_path / stream))
        stage_to_lake(spark.read.parquet(str(tmp_path / stream)), str(tmp_path / "lake"), stream, "b", day(1))
        files = glob.glob(f"{tmp_path}/lake/default/{stream}/extracted_date=2024-01-01/*/*.gz")
        sizes = [len(gzip.open(f).read()) for f in files]
        assert len(files) >= 4 and max(sizes) < 1.3 * (1 << 20)
        assert len(glob.glob(f"{tmp_path}/lake/default/{stream}/*/*/*.gz")) < 30


def test_a_value_the_table_cannot_hold_stops_the_load(spark, database):
    def number(kind, value):
        return [schema("counts", {"id": {"type": "integer"}, "v": {"type": kind}}, ["id"]), record("counts", {"id": 1, "v": value})]

    load(spark, database, number("integer", 1), day(1))
    load(spark, database, number("number", 2.0), day(2))
    with pytest.raises(Exception, match="does not fit a bigint column"):
        load(spark, database, number("number", 2.9), day(3))
    assert sorted(r.v for r in spark.table(f"{database}.counts").collect()) == [1, 2]


def test_old_staging_is_swept_by_loads(spark, database, tmp_path):
    (tmp_path / staging_name("people", day(1))).mkdir()
    load(spark, database, people((1, "a")), day(20), staging_root=str(tmp_path))
    assert list(tmp_path.iterdir()) == []


def test_loading_a_frame(spark, database):
    name = f"{database}.plain"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, v STRING")
    load_frame(df, name)
    load_frame(df.withColumn("w", F.lit(1)), name, cluster=["id"])
    assert rows(spark.table(name)) == [(1, "a", 1), (1, "a", None), (2, "b", 1), (2, "b", None)]
    load_frame(df, name, "overwrite")
    load_frame(spark.createDataFrame([(2, "B"), (3, "c")], "id INT, v STRING"), name, "upsert", keys=["id"])
    assert rows(spark.table(name)) == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(ValueError, match="Unknown write mode"):
        load_frame(df, name, "replace")
    with pytest.raises(ValueError, match="needs key properties"):
        load_frame(df, name, "upsert")


def test_streams_that_share_a_table(spark, database):
    messages = [m for s in ("a-b", "a.b", "c", "d", "e") for m in (schema(s, PEOPLE, ["id"]), record(s, {"id": 1, "name": s}))]
    results, _ = load(spark, database, messages, fail_fast=False)
    assert [r.table.split(".")[1] for r in results] == ["a_b", "a_b", "c", "d", "e"]
    assert names(spark, database, "a_b") == [(1, "a-b"), (1, "a.b")]


def test_many_tables_reject_rows_at_the_same_time(spark, database):
    messages = [m for s in "abcdef" for m in (schema(s, PEOPLE, ["id"]), record(s, {"id": "bad"}), record(s, {"id": 1, "name": s}))]
    results, _ = load(spark, database, messages, fail_fast=False)
    assert [(r.rows, r.rejected) for r in results] == [(1, 1)] * 6
    assert rows(spark.table(f"{database}.quarantine"), "stream") == [(s,) for s in "abcdef"]


def test_one_bad_stream_leaves_the_bookmark(spark, database, tmp_path):
    messages = [m for s in "abcde" for m in (schema(s, PEOPLE, ["id"]), record(s, {"id": 1 if s != "d" else "bad"}))]
    with pytest.raises(LoadError, match="d: 1 of 1 records"):
        load(spark, database, messages + [state({"n": 1})], state_path=str(tmp_path / "state"))
    assert not (tmp_path / "state").exists()
    assert [spark.table(f"{database}.{s}").count() for s in "abcde"] == [0] * 5  # no table moved
    fixed = [m for m in messages if m.get("record") != {"id": "bad"}]
    load(spark, database, fixed + [state({"n": 1})], day(2), state_path=str(tmp_path / "state"))
    assert [spark.table(f"{database}.{s}").count() for s in "abcde"] == [1, 1, 1, 0, 1]


@pytest.mark.parametrize("denormalized", [True, False])
def test_given_streams_need_one_pass(spark, database, monkeypatch, denormalized):
    def refuse(_):
        raise AssertionError("the log was read for its facts")

    monkeypatch.setattr("sluiceway.plans.loads.log_facts", refuse)
    spec = StreamSpec("people", {"properties": PEOPLE}, ("id",))
    messages = [record("people", {"id": 1}), state({"n": 1}), state({"n": 2}), record("people", {"id": 2})]
    settings = {"database": database, "denormalized": denormalized}
    [result], bookmark = load_messages(spark, lines(spark, messages), settings, day(1), {"people": spec})
    assert result.rows == 2 and json.loads(bookmark) == {"n": 2}
    batch = {"type": "BATCH", "stream": "people", "manifest": ["x"]}
    with pytest.raises(LoadError, match="names batch files"):
        load_messages(spark, lines(spark, [batch]), {**settings, "fail_fast": False}, day(2), {"people": spec})
    with pytest.raises(LoadError, match="1 lines are no message"):
        load_messages(spark, lines(spark, ["garbage"]), settings, day(2), {"people": spec})


def test_key_order_in_a_message_does_not_matter(spark, database):
    turned = ['{"record":{"id":"bad","name":"x"},"stream":"people","type":"RECORD"}', '{"record":{"name":"y","id":5},"stream":"people","type":"RECORD"}']
    [result], _ = load(spark, database, people() + turned, fail_fast=False)
    assert (result.rows, result.rejected) == (1, 1) and names(spark, database) == [(5, "y")]


def test_partitions_are_written_without_sorting_a_task(spark, tmp_path):
    """A task writes a few partitions side by side; those beyond are sorted, and no row is lost."""
    from sluiceway.session import prepare_session

    prepare_session(spark)
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0
    spark.range(1000).selectExpr("id", "id % 9 AS part").coalesce(1).write.partitionBy("part").parquet(f"{tmp_path}/out")
    assert sorted((r.id, r.part) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [(i, i % 9) for i in range(1000)]
