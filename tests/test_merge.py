import random

import pytest
from pyspark.sql import functions as F

from sluiceway.operators import conflicts, dedupe_latest, merge_columns, upsert
from sluiceway.operators.merge import matched_keys

from .conftest import plan, rows


def model_upsert(target, source, keys):
    """Row-by-row merge of lists of dicts: the definition, for small data."""
    shared = [c for c in target["columns"] if c in source["columns"]]
    same = lambda a, b: all(a[k] is not None and a[k] == b[k] for k in keys)
    out = []
    for t in target["rows"]:
        hit = [s for s in source["rows"] if same(t, s)]
        out.append({**t, **{c: hit[0][c] for c in shared if c not in keys}} if hit else t)
    for s in source["rows"]:
        if not any(same(t, s) for t in target["rows"]):
            out.append({c: s[c] if c in shared else None for c in target["columns"]})
    return sorted((tuple(r[c] for c in target["columns"]) for r in out), key=repr)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_upsert_against_the_definition(spark, seed, limit):
    """Null keys, target duplicates and a hot key, by broadcast and by shuffle."""
    rnd = random.Random(seed)
    key = lambda: rnd.choice([None, 1, 1, 1, *range(2, 12)])
    target = {"columns": ["a", "b", "v", "t_only"], "rows": [{"a": key(), "b": rnd.choice(["x", "y"]), "v": rnd.randrange(99), "t_only": i} for i in range(40)]}
    unique = {}
    for i in range(30):
        row = {"b": rnd.choice(["x", "y", "z"]), "s_only": i, "a": key(), "v": rnd.choice([None, i])}
        unique[(row["a"], row["b"]) if row["a"] is not None else (None, i)] = row
    source = {"columns": ["b", "s_only", "a", "v"], "rows": list(unique.values())}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        t = spark.createDataFrame(target["rows"], "a INT, b STRING, v INT, t_only INT")
        s = spark.createDataFrame(source["rows"], "b STRING, s_only INT, a INT, v INT")
        got = upsert(t, s, ["a", "b"])
        assert got.columns == target["columns"]
        assert rows(got) == model_upsert(target, source, ["a", "b"])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_twice_is_upsert_once(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, v STRING")
    s = spark.createDataFrame([(2, None), (3, "c")], "id INT, v STRING")
    once = upsert(t, s, ["id"])
    assert rows(once) == rows(upsert(once, s, ["id"])) == [(1, "a"), (2, None), (3, "c")]


def test_null_keys_insert_every_time(spark):
    t = spark.createDataFrame([(None, "a")], "id INT, v STRING")
    s = spark.createDataFrame([(None, "b")], "id INT, v STRING")
    assert rows(upsert(upsert(t, s, ["id"]), s, ["id"])) == [(None, "a"), (None, "b"), (None, "b")]


def test_shared_columns_and_keys_only(spark):
    t = spark.createDataFrame([(1, "old", "keep")], "id INT, value STRING, target_only STRING")
    s = spark.createDataFrame([(1, "new", 7), (2, "ins", 8)], "id BIGINT, value STRING, source_only INT")
    assert rows(upsert(t, s, ["id"])) == [(1, "new", "keep"), (2, "ins", None)]
    assert rows(upsert(t, s.select("id"), ["id"])) == [(1, "old", "keep"), (2, None, None)]


def test_preconditions():
    assert merge_columns(["id", "v", "t"], ["v", "s", "id"], ["id"]) == ["id", "v"]
    with pytest.raises(ValueError, match="needs key properties"):
        merge_columns(["id"], ["id"], [])
    with pytest.raises(ValueError, match="share no columns"):
        merge_columns(["a"], ["b"], ["a"])
    with pytest.raises(ValueError, match="missing from the shared columns: k"):
        merge_columns(["a", "k"], ["a"], ["k"])


def test_newer_rows_win_with_the_guard(spark):
    shape = "id INT, v STRING, _sdc_extracted_at INT"
    t = spark.createDataFrame([(1, "new", 9), (2, "old", 1), (3, "unknown", None)], shape)
    s = spark.createDataFrame([(1, "late", 5), (2, "x", 1), (3, "y", 0)], shape)
    assert rows(upsert(t, s, ["id"], only_if_newer=True)) == [(1, "new", 9), (2, "x", 1), (3, "y", 0)]


def test_dedupe_order_nulls_and_null_keys(spark):
    df = spark.createDataFrame(
        [(1, 5, 1, "a"), (1, None, 9, "b"), (1, 5, 2, "c"), (None, 1, 1, "d"), (None, 2, 1, "e")],
        "id INT, _sdc_extracted_at INT, _sdc_sequence INT, v STRING",
    )
    once = dedupe_latest(df, ["id"])
    assert rows(once, "v") == [("c",), ("e",)]
    assert rows(dedupe_latest(once, ["id"])) == rows(once)


def test_a_hot_key_is_thinned_before_the_shuffle(spark):
    key = F.when(F.col("id") < 900, 1).otherwise(F.col("id"))  # one key holds most rows
    df = spark.range(1000, numPartitions=4).select(key.alias("id"), F.col("id").alias("_sdc_extracted_at"))
    out = dedupe_latest(df, ["id"])
    text = plan(out)
    assert text.index("row_number(), 1, Final") < text.index("Exchange hashpartitioning") < text.index("row_number(), 1, Partial")
    assert rows(out)[0] == (1, 899) and out.count() == 101


def test_a_small_source_leaves_the_target_in_place(spark, tmp_path):
    spark.range(2000).withColumn("v", F.lit("t")).write.parquet(str(tmp_path / "t"))
    spark.range(10).withColumn("v", F.lit("s")).write.parquet(str(tmp_path / "s"))
    t, s = (spark.read.parquet(str(tmp_path / n)) for n in "ts")
    text = plan(upsert(t, s, ["id"]))
    updates = text[: text.index("LeftOuter")]
    assert "BroadcastHashJoin" in updates and "SortMergeJoin" not in text and "CartesianProduct" not in text


def test_conflicts(spark):
    t = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id INT")
    s = spark.createDataFrame([(1,), (1,), (2,), (9,), (9,), (None,), (None,)], "id INT")
    assert rows(conflicts(t, s, ["id"])) == [(1, 2)]
    assert rows(matched_keys(t, s, ["id"])) == [(1,), (2,)]


def test_columns_that_differ_in_case_are_one(spark):
    target = spark.createDataFrame([(1, "old"), (2, "kept")], "Id INT, Val STRING")
    source = spark.createDataFrame([(1, "new"), (3, "added")], "id INT, val STRING")
    merged = upsert(target, source, ["id"])
    assert merged.columns == ["Id", "Val"]
    assert sorted(map(tuple, merged.collect())) == [(1, "new"), (2, "kept"), (3, "added")]


def test_newer_needs_the_time_on_both_sides(spark):
    frame = spark.createDataFrame([(1, "a")], "id INT, v STRING")
    with pytest.raises(ValueError, match="_sdc_extracted_at"):
        upsert(frame, frame, ["id"], only_if_newer=True)
