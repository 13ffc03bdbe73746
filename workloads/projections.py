"""Schema translation, renaming, envelopes, typed views, maps and flattening."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import sluiceway as sw
from sluiceway.functions import StreamSpec

from .registry import query
from .render import AS_OF, log_of, plain, record_lines, schema_line, spec_of, table

METADATA = list(sw.METADATA_COLUMNS)


def typed(
    spark: SparkSession, df: DataFrame, spec: StreamSpec, rules: dict | None = None, resolver: int = 1
) -> DataFrame:
    """A frame sent through a message log and typed again."""
    msgs = sw.as_messages(log_of(spark, df, spec))
    declared = sw.stream_specs(msgs)[spec.name]
    return plain(sw.project_denormalized(msgs, declared, rules, resolver).drop(*METADATA))


def fixed(spark: SparkSession, df: DataFrame, stream: str, extracted: str | None = None) -> DataFrame:
    return sw.project_fixed(sw.as_messages(record_lines(df, stream, extracted)), stream)


# ---- schema translation ---------------------------------------------------


@query("SELECT * FROM orders")
def denorm_v1(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return typed(spark, orders, spec_of(orders, "orders", ["o_orderkey"]))


def _events_with_props(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "event_type", F.parse_json("props").alias("props"), "value")


@query("""
SELECT event_id, event_type, '{"k":' || json_extract_string(props, '$.k') || '}' AS props,
       '"' || event_type || '"' AS untyped FROM events
""")
def denorm_v2_variant(spark: SparkSession, sf: str) -> DataFrame:
    """What the lenient resolver cannot type, it keeps as JSON."""
    df = _events_with_props(spark, sf).select("event_id", "event_type", "props", F.col("event_type").alias("untyped"))
    spec = StreamSpec(
        "events",
        {"properties": {
            "event_id": {"type": "integer"},
            "event_type": {"type": ["string", "null"]},
            "props": {"type": "object", "patternProperties": {".*": {"type": "integer"}}},
            "untyped": {"description": "no type at all"},
        }},
    )
    out = typed(spark, df, spec, resolver=2)
    return out.select("event_id", "event_type", F.to_json("props").alias("props"), F.to_json("untyped").alias("untyped"))


@query("SELECT event_id, ts, value, event_type FROM events")
def denorm_anyof(spark: SparkSession, sf: str) -> DataFrame:
    """Only the first option of anyOf counts."""
    df = table(spark, sf, "events").select("event_id", "ts", "value", "event_type")
    spec = StreamSpec(
        "events",
        {"properties": {
            "event_id": {"anyOf": [{"type": "integer"}, {"type": "null"}]},
            "ts": {"anyOf": [{"type": "string", "format": "date-time"}, {"type": "null"}]},
            "value": {"anyOf": [{"type": "number"}, {"type": "string"}]},
            "event_type": {"anyOf": [{"description": "untyped"}, {"type": "integer"}]},
        }},
    )
    return typed(spark, df, spec)


def _line_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with an array of text, an array of records and an array of arrays, row by row."""
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.array("l_returnflag", F.lit(None).cast("string"), "l_linestatus").alias("flags"),
        F.array(
            F.struct(F.lit("base").alias("kind"), F.col("l_extendedprice").alias("amount")),
            F.struct(F.lit("discount").alias("kind"), F.col("l_discount").alias("amount")),
        ).alias("prices"),
        F.array(F.array("l_linenumber", "l_suppkey")).alias("pairs"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_returnflag || '/?/' || l_linestatus AS flags, 'base' AS kind, l_extendedprice AS amount,
       '[' || l_linenumber || ',' || l_suppkey || ']' AS pair FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, l_returnflag || '/?/' || l_linestatus, 'discount', l_discount,
       '[' || l_linenumber || ',' || l_suppkey || ']' FROM lineitem
""")
def denorm_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """Arrays of scalars, of records, and of arrays (kept as text)."""
    df = _line_arrays(spark, sf)
    spec = spec_of(df, "lines", pairs={"type": "array", "items": {"type": ["array"]}})
    out = typed(spark, df, spec)
    return out.select(
        "l_orderkey",
        F.col("l_linenumber").cast("int").alias("l_linenumber"),
        F.array_join("flags", "/", "?").alias("flags"),
        F.inline("prices"),
        F.col("pairs")[0].alias("pair"),
    ).select("l_orderkey", "l_linenumber", "flags", "kind", "amount", "pair")


def _nested_customer(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("CustKey"),
        F.struct(
            F.col("c_name").alias("FullName"),
            F.struct(F.col("c_nationkey").alias("NationKey"), F.col("c_mktsegment").alias("MktSegment")).alias("HomeMarket"),
            F.array(F.struct(F.col("c_acctbal").alias("AcctBal"))).alias("AccountList"),
        ).alias("Profile"),
    )


@query("SELECT c_custkey AS key, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, c_acctbal AS balance FROM customer")
def denorm_nested(spark: SparkSession, sf: str) -> DataFrame:
    df = _nested_customer(spark, sf)
    out = typed(spark, df, spec_of(df, "customer"))
    return out.select(
        F.col("CustKey").alias("key"),
        F.col("Profile.FullName").alias("name"),
        F.col("Profile.HomeMarket.NationKey").cast("int").alias("nation"),
        F.col("Profile.HomeMarket.MktSegment").alias("segment"),
        F.col("Profile.AccountList")[0]["AcctBal"].alias("balance"),
    )


@query("SELECT o_orderkey AS order_key, o_custkey AS order_key_1, o_orderstatus AS order_key_2 FROM orders")
def name_collision(spark: SparkSession, sf: str) -> DataFrame:
    """Names that meet after the rules: schema and data get the same suffixes."""
    spec = StreamSpec("orders", {"properties": {
        "OrderKey": {"type": "integer"}, "order_key": {"type": "integer"}, "Order_Key": {"type": "string"},
    }})
    orders = table(spark, sf, "orders")
    line = F.format_string(
        '{"type":"RECORD","stream":"orders","record":{"OrderKey":%d,"order_key":%d,"Order_Key":"%s"}}',
        "o_orderkey", "o_custkey", "o_orderstatus",
    )
    msgs = sw.as_messages(schema_line(spark, spec).union(orders.select(line)))
    return sw.project_denormalized(msgs, sw.stream_specs(msgs)["orders"], {"snake_case": True}).drop(*METADATA)


@query("SELECT o_orderkey, o_totalprice FROM orders")
def drop_unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    return typed(spark, orders, spec_of(orders.select("o_orderkey", "o_totalprice"), "orders"))


# ---- renaming -------------------------------------------------------------


@query("""
SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS order_status, o_totalprice AS total_price,
       o_orderdate AS order_date, o_orderpriority AS allcaps FROM orders
""")
def rename_snake_case(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").toDF("OrderKey", "CustKey", "OrderStatus", "TotalPrice", "OrderDate", "ALLCAPS")
    return typed(spark, orders, spec_of(orders, "orders"), {"snake_case": True})


@query("""
SELECT p_partkey AS "_1stkey", p_name AS name_text, p_brand AS brand, p_type AS typecode FROM part
""")
def rename_rules(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type").toDF("1stKey", "Name.Text", "`Brand", "TypeCode")
    spec = spec_of(part, "part")
    rules = {"lower": True, "add_underscore_when_invalid": True, "replace_period_with_underscore": True, "quote": True}
    return typed(spark, part, spec, rules)


@query("SELECT c_custkey AS cust_key, c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer")
def rename_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Renamed through structs and arrays of structs."""
    df = _nested_customer(spark, sf)
    out = typed(spark, df, spec_of(df, "customer"), {"snake_case": True})
    return out.select(
        "cust_key",
        F.col("profile.full_name").alias("name"),
        F.col("profile.home_market.nation_key").cast("int").alias("nation"),
        F.col("profile.account_list")[0]["acct_bal"].alias("balance"),
    )


# ---- envelopes ------------------------------------------------------------


@query("""
SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}' AS data,
       ts AS _sdc_extracted_at, CAST(NULL AS TIMESTAMP) AS _sdc_received_at, CAST(NULL AS TIMESTAMP) AS _sdc_batched_at,
       CAST(NULL AS TIMESTAMP) AS _sdc_deleted_at, event_id AS _sdc_sequence, CAST(NULL AS BIGINT) AS _sdc_table_version
FROM events
""")
def fixed_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """The record without its metadata keys, and those keys as columns."""
    events = table(spark, sf, "events").select(
        "event_id", "event_type", "user_id", F.col("ts").alias("_sdc_extracted_at"), F.col("event_id").alias("_sdc_sequence")
    )
    return plain(fixed(spark, events, "events").withColumn("data", F.to_json("data")))


@query("""
SELECT event_id, '{"event_id":' || event_id || ',"tags":["' || event_type || '"]}' AS data, '[{"k":' || json_extract_string(props, '$.k') || '}]' AS list
FROM events
""")
def serialize_json(spark: SparkSession, sf: str) -> DataFrame:
    """JSON columns as text, also inside arrays."""
    events = table(spark, sf, "events").select("event_id", F.array("event_type").alias("tags"))
    rows = fixed(spark, events, "events").select(F.expr("variant_get(data, '$.event_id', 'bigint')").alias("event_id"), "data")
    lists = table(spark, sf, "events").select("event_id", F.array(F.parse_json("props")).alias("list"))
    return sw.json_text(rows.join(lists, "event_id"))


@query("""
SELECT event_id, value, ts AS _sdc_extracted_at, TIMESTAMP '2024-03-01 12:00:00' AS _sdc_received_at,
       TIMESTAMP '2024-03-01 12:00:00' AS _sdc_batched_at, CAST(NULL AS TIMESTAMP) AS _sdc_deleted_at,
       CAST(1709294400000 AS BIGINT) AS _sdc_sequence, CAST(NULL AS BIGINT) AS _sdc_table_version
FROM events
""")
def stamp_metadata(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "value", "ts")
    spec = spec_of(events.select("event_id", "value"), "events", ["event_id"])
    msgs = sw.as_messages(record_lines(events, "events", "ts"))
    return plain(sw.project_denormalized(msgs, spec, as_of=AS_OF))


@query("""
SELECT l_orderkey, l_linenumber,
       regexp_replace(CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR), '\\.?0+$', '') AS quantity,
       '[{"price":' || regexp_replace(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR), '\\.?0+$', '') || '}]' AS items
FROM lineitem
""")
def normalize_decimals(spark: SparkSession, sf: str) -> DataFrame:
    """Whole decimals become integers at any depth."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.col("l_quantity").cast("decimal(12,2)").alias("quantity"),
        F.array(F.struct(F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))).alias("items"),
    )
    out = sw.normalize_numbers(lines)
    return out.withColumn("quantity", F.to_json("quantity")).withColumn("items", F.to_json("items"))


# ---- typed views ----------------------------------------------------------


def view(spark: SparkSession, df: DataFrame, struct: T.StructType, stream: str = "s", **options) -> DataFrame:
    return sw.typed_view(fixed(spark, df, stream), struct, **options)


@query("""
SELECT event_id, user_id, event_type, value, ts, strftime(ts, '%Y-%m-%d') AS day,
       CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 AS even, CAST(NULL AS VARCHAR) AS nested FROM events
""")
def typed_view_scalar(spark: SparkSession, sf: str) -> DataFrame:
    """Every scalar type; an object under a text property reads as null."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", "ts", F.col("ts").cast("date").alias("day"),
        (k % 2 == 0).alias("even"), F.struct(F.col("value").alias("v")).alias("nested"),
    )
    kinds = {"event_id": "integer", "user_id": "integer", "event_type": "string", "value": "number", "even": "boolean", "nested": "string"}
    properties = {n: {"type": [k, "null"]} for n, k in kinds.items()}
    properties["ts"] = {"type": "string", "format": "date-time"}
    properties["day"] = {"type": "string", "format": "date"}
    out = plain(view(spark, events, sw.to_struct({"properties": properties})))
    return out.withColumn("day", F.col("day").cast("string"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderkey ELSE -1 END AS maybe FROM orders
""")
def typed_view_lenient(spark: SparkSession, sf: str) -> DataFrame:
    """With ``strict=False`` a value of the wrong type, or a fraction under an integer, is null."""
    bad = F.when(F.col("o_orderstatus") == "O", F.lit("not a number")).otherwise(F.lit("1.5"))
    value = F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey").cast("string")).otherwise(bad)
    orders = table(spark, sf, "orders").select("o_orderkey", value.alias("maybe"))
    struct = sw.to_struct({"properties": {"o_orderkey": {"type": "integer"}, "maybe": {"type": "integer"}}})
    return view(spark, orders, struct, strict=False).fillna(-1, ["maybe"])


@query("""
SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS props FROM events
""")
def typed_view_json(spark: SparkSession, sf: str) -> DataFrame:
    struct = sw.to_struct({"properties": {"event_id": {"type": "integer"}, "props": {"type": ["object", "null"]}}})
    out = view(spark, _events_with_props(spark, sf), struct)
    return out.withColumn("props", F.to_json("props"))


@query("SELECT o_orderkey, o_orderdate FROM orders")
def typed_view_ts_format(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(" +0000")).alias("o_orderdate")
    )
    struct = sw.to_struct({"properties": {"o_orderkey": {"type": "integer"}, "o_orderdate": {"type": "string", "format": "date-time"}}})
    return plain(view(spark, orders, struct, ts_format="%Y-%m-%d %H:%M:%S %z"))


@query("""
SELECT c_custkey AS cust_key, c_name AS name, c_nationkey AS nation, c_mktsegment AS segment, true AS absent_is_struct FROM customer
""")
def typed_view_struct(spark: SparkSession, sf: str) -> DataFrame:
    """A struct of typed values, also where the object is missing."""
    df = _nested_customer(spark, sf)
    declared = spec_of(df, "customer", Missing={"type": "object", "properties": {"Part": {"type": "integer"}}})
    out = view(spark, df, sw.to_struct(declared.json_schema), rules={"snake_case": True})
    return out.select(
        "cust_key", F.col("profile.full_name").alias("name"),
        F.col("profile.home_market.nation_key").cast("int").alias("nation"),
        F.col("profile.home_market.mkt_segment").alias("segment"),
        F.col("missing").isNotNull().alias("absent_is_struct"),
    )


@query("""
SELECT l_orderkey, l_linenumber, l_returnflag || '/' || l_linestatus AS flags, 0 AS absent FROM lineitem
""")
def typed_view_scalar_array(spark: SparkSession, sf: str) -> DataFrame:
    """Null elements are dropped; a missing array is an empty one."""
    df = _line_arrays(spark, sf)
    spec = spec_of(df, "lines", absent={"type": "array", "items": {"type": "number"}})
    out = view(spark, df, sw.to_struct(spec.json_schema))
    return out.select(
        "l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"),
        F.array_join("flags", "/", "?").alias("flags"), F.size("absent").alias("absent"),
    )


@query("""
SELECT l_orderkey, l_linenumber, 'base' AS kind, l_extendedprice AS amount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_discount FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, NULL, NULL FROM lineitem
""")
def typed_view_record_array(spark: SparkSession, sf: str) -> DataFrame:
    """Records keep their place: a null element is a record of nulls."""
    df = _line_arrays(spark, sf)
    spec = spec_of(df, "lines")
    with_null = df.withColumn("prices", F.array_append("prices", F.lit(None)))
    out = view(spark, with_null, sw.to_struct(spec.json_schema))
    return out.select("l_orderkey", F.col("l_linenumber").cast("int").alias("l_linenumber"), F.inline("prices"))


@query("SELECT event_id, ts AS _sdc_extracted_at FROM events")
def typed_view_meta(spark: SparkSession, sf: str) -> DataFrame:
    """The six metadata columns pass through, other ``_sdc_`` properties are left out."""
    events = table(spark, sf, "events").select(
        "event_id", F.col("ts").alias("_sdc_extracted_at"), F.col("ts").alias("_sdc_sync_started_at")
    )
    return plain(view(spark, events, sw.to_struct(spec_of(events, "events").json_schema)))


@query("""
SELECT user_id, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k, count(*) AS n FROM events
GROUP BY user_id
""")
def json_path_query(spark: SparkSession, sf: str) -> DataFrame:
    """Paths into the fixed shape."""
    df = table(spark, sf, "events").select("user_id", F.parse_json("props").alias("props"))
    rows = fixed(spark, df, "events")
    return rows.groupBy(F.expr("variant_get(data, '$.user_id', 'bigint')").alias("user_id")).agg(
        F.sum(F.expr("variant_get(data, '$.props.k', 'bigint')")).alias("k"), F.count("*").alias("n")
    )


# ---- maps and flattening --------------------------------------------------


@query("SELECT 'clients' AS stream, c_custkey FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier")
def stream_alias(spark: SparkSession, sf: str) -> DataFrame:
    lines = record_lines(table(spark, sf, "customer"), "shop-customer").union(record_lines(table(spark, sf, "supplier"), "supplier"))
    msgs = sw.alias_streams(sw.as_messages(lines), {"shop-customer": "clients"})
    record = F.from_json("payload", "record STRUCT<c_custkey: BIGINT, s_suppkey: BIGINT>")["record"]
    return msgs.select("stream", F.coalesce(record["c_custkey"], record["s_suppkey"]).alias("c_custkey"))


@query("""
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice * (1 - l_discount) AS net, 'EUR' AS currency
FROM lineitem WHERE l_returnflag <> 'R'
""")
def stream_map_expr(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    exprs = {
        "net": "l_extendedprice * (1 - l_discount)", "currency": "config.currency",
        "l_extendedprice": None, "l_discount": None, "l_returnflag": None,
    }
    return sw.map_stream(lines, exprs, "l_returnflag <> 'R'", config={"currency": "EUR"})


@query("""
SELECT c_custkey AS "CustKey", c_name AS "Profile__FullName",
       '{"NationKey":' || c_nationkey || ',"MktSegment":"' || c_mktsegment || '"}' AS "Profile__HomeMarket",
       c_acctbal AS "Profile__AccountList" FROM customer
""")
def flatten_depth1(spark: SparkSession, sf: str) -> DataFrame:
    flat = sw.flatten(_nested_customer(spark, sf), 1)
    return flat.withColumn("Profile__AccountList", F.col("Profile__AccountList")[0]["AcctBal"])  # arrays stay as they are


@query("""
SELECT c_custkey AS "CustKey", c_name AS "Profile__FullName", c_nationkey AS "Profile__HomeMarket__NationKey",
       c_mktsegment AS "Profile__HomeMarket__MktSegment", c_acctbal AS "Profile__AccountList" FROM customer
""")
def flatten_depth2(spark: SparkSession, sf: str) -> DataFrame:
    flat = sw.flatten(_nested_customer(spark, sf), 2)
    return flat.withColumn("Profile__AccountList", F.col("Profile__AccountList")[0]["AcctBal"])  # arrays stay as they are


# ---- row checks -----------------------------------------------------------


@query("SELECT event_id, event_type <> 'error' AS valid FROM events")
def validate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A missing key is invalid, a null one is not."""
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    kept = F.when(F.col("event_type") == "view", F.lit(None)).otherwise(F.col("user_id"))
    with_key = events.filter("event_type <> 'error'").select("event_id", kept.alias("user_id"))
    without = events.filter("event_type = 'error'").select("event_id")
    lines = record_lines(with_key, "events").union(record_lines(without, "events"))
    good, bad = sw.split_valid(sw.project_fixed(sw.as_messages(lines), "events"), ["user_id"])
    event_id = F.expr("variant_get(data, '$.event_id', 'bigint')").alias("event_id")
    return good.select(event_id, F.lit(True).alias("valid")).union(bad.select(event_id, F.lit(False).alias("valid")))
