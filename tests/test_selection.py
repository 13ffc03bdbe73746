import pytest
from pyspark.sql import functions as F

from sluiceway import LoadConfig, StreamSpec, java_pattern, resolve_mode
from sluiceway.functions import is_selected, selects

# A selection, and whether it picks the stream `orders`.
SELECTIONS = [
    (True, True), (False, False), (None, False), (1, True),
    ("true", True), ("FALSE", False), (" on ", True), ("", False), ("null", False),
    ("orders", True), ("customers", False), ("customers,orders", True), ("customers, ord*", True),
    ("orders,!orders", False), ('["!orders", "orders"]', True), ('["orders", false]', False),
    (["customers", "orders"], True), (["orders", "!orders"], False), (["!orders", "orders"], True),
    (["*", "!o?ders"], False), (["o[!x]ders"], True), ([], False), ("[broken", False), (["*", 0], False),
]


@pytest.mark.parametrize("selection, expected", SELECTIONS)
def test_selection_of_one_stream(selection, expected):
    assert is_selected(selection, "orders") is expected


def test_the_column_agrees_with_the_rule(spark):
    names = ["orders", "Orders", "customers", "o.ders", "orders\n", "xorders", "ordersx"]
    df = spark.createDataFrame([(n,) for n in names], "stream STRING")
    for selection, _ in SELECTIONS:
        got = {r.stream: r.hit for r in df.select("stream", selects(selection).alias("hit")).collect()}
        assert got == {n: is_selected(selection, n) for n in names}, selection


def test_modes():
    keyed, keyless = StreamSpec("orders", {}, ("id",)), StreamSpec("orders")
    assert resolve_mode(keyed, LoadConfig()) == "append"
    assert resolve_mode(keyed, LoadConfig(denormalized=True, upsert=True, overwrite=True)) == "upsert"
    assert resolve_mode(keyed, LoadConfig(denormalized=True, overwrite="ord*")) == "overwrite"
    with pytest.warns(UserWarning, match="upsert needs"):
        assert resolve_mode(keyed, LoadConfig(upsert=True)) == "append"
    with pytest.warns(UserWarning, match="upsert needs"):
        assert resolve_mode(keyless, LoadConfig(denormalized=True, upsert=True, overwrite=True)) == "overwrite"


def test_settings_are_checked():
    with pytest.raises(ValueError, match="unknown settings: upsrt"):
        LoadConfig.of({"upsrt": True})
    with pytest.raises(ValueError, match="Unknown method"):
        LoadConfig.of({"method": "carrier_pigeon"})


def test_settings_of_other_loaders():
    config = LoadConfig.of({"dataset": "d", "bucket": "/lake", "method": "gcs_stage", "batch_size": 500, "project": "p", "clustering_fields": None})
    assert (config.database, config.lake_root, config.method, config.clustering_fields) == ("d", "/lake", "lake_stage", ())


def test_timestamp_patterns(spark):
    assert java_pattern("%Y-%m-%d %H:%M:%S %z") == "yyyy-MM-dd HH:mm:ss Z"
    assert java_pattern("%FT%T") == "yyyy-MM-dd'T'HH:mm:ss"
    with pytest.raises(ValueError, match="%Q"):
        java_pattern("%Y %Q")
    df = spark.createDataFrame([("at 2024-02-03 'n 04:05 100%",)], "s STRING")
    got = df.select(F.to_timestamp("s", java_pattern("at %F 'n %R 100%%")).alias("t")).first().t
    assert (got.year, got.month, got.day, got.hour, got.minute) == (2024, 2, 3, 4, 5)


def test_literals_of_formats_are_quoted_and_a_lone_percent_is_refused():
    assert java_pattern("%Y [%m]") == "yyyy '['MM']'"
    for wrong in ("%Y %", "%"):
        with pytest.raises(ValueError, match="unsupported directive"):
            java_pattern(wrong)
