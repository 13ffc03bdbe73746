"""Merges, table loads, layout, staging and streaming."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sluiceway as sw
from sluiceway.functions import StreamSpec
from sluiceway.operators.merge import matched_keys
from sluiceway.session import scratch_path

from .registry import query
from .render import (
    AS_OF, log_of, log_parts, plain, record_lines, schema_line, scratch_database, spec_of, state_line, table, written_log,
)

METADATA = list(sw.METADATA_COLUMNS)


# ---- merge operators ------------------------------------------------------


@query("""
SELECT event_id, user_id, ts, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) = 1
""")
def dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return sw.dedupe_latest(events, ["user_id"], ["ts", "event_id"])


def _landed_and_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders landed earlier, and a later extract that overlaps them by a year."""
    orders = table(spark, sf, "orders")
    landed = orders.filter("o_orderdate < TIMESTAMP_NTZ '1999-01-01'").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.lit(0.0).alias("o_totalprice"), "o_orderdate"
    )
    fresh = orders.filter("o_orderdate >= TIMESTAMP_NTZ '1998-01-01'").select(
        "o_orderkey", "o_custkey", F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"), "o_totalprice", "o_orderdate"
    )
    return landed, fresh


LANDED = """
WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, 0.0::DOUBLE AS o_totalprice, o_orderdate FROM orders
           WHERE o_orderdate < TIMESTAMP '1999-01-01'),
     s AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus, o_totalprice, o_orderdate FROM orders
           WHERE o_orderdate >= TIMESTAMP '1998-01-01')
"""


@query(LANDED + """
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderdate ELSE t.o_orderdate END AS o_orderdate
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
""")
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    landed, fresh = _landed_and_new(spark, sf)
    return sw.upsert(landed, fresh, ["o_orderkey"])


@query(LANDED + """
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       t.o_orderstatus AS target_only
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
""")
def upsert_shared_cols(spark: SparkSession, sf: str) -> DataFrame:
    """Source-only columns are dropped, target-only ones kept on update and null on insert."""
    landed, fresh = _landed_and_new(spark, sf)
    target = landed.select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("target_only"))
    source = fresh.select("o_orderkey", "o_totalprice", F.col("o_orderdate").alias("source_only"))
    return sw.upsert(target, source, ["o_orderkey"])


@query(LANDED + "SELECT o_orderkey, o_orderstatus FROM t UNION ALL SELECT o_orderkey, NULL FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)")
def upsert_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    """With only keys in common there is nothing to update."""
    landed, fresh = _landed_and_new(spark, sf)
    return sw.upsert(landed.select("o_orderkey", "o_orderstatus"), fresh.select("o_orderkey"), ["o_orderkey"])


@query("""
WITH s AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS source_rows FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_linenumber, source_rows FROM s WHERE source_rows > 1
AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
""")
def upsert_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that several source rows would update, in a target of finished orders' lines."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_quantity")
    finished = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    target = sw.dedupe_latest(lines, ["l_orderkey", "l_linenumber"], ["l_quantity"]).join(finished, "l_orderkey", "left_semi")
    return sw.conflicts(target, lines, ["l_orderkey", "l_linenumber"])


@query("""
WITH t AS (SELECT event_id, user_id, value FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) = 1),
     s AS (SELECT event_id, user_id, value FROM events
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) = 1)
SELECT s.user_id, CASE WHEN s.value >= t.value THEN s.event_id ELSE t.event_id END AS event_id,
       CASE WHEN s.value >= t.value THEN s.value ELSE t.value END AS _sdc_extracted_at
FROM t JOIN s ON t.user_id = s.user_id
""")
def upsert_newer_only(spark: SparkSession, sf: str) -> DataFrame:
    """The optional guard: an older source row does not overwrite a newer target row."""
    events = table(spark, sf, "events").select("user_id", "event_id", F.col("value").alias("_sdc_extracted_at"))
    first = sw.dedupe_latest(events.withColumn("age", -F.col("event_id")), ["user_id"], ["age"]).drop("age")
    top = sw.dedupe_latest(events, ["user_id"], ["_sdc_extracted_at", "event_id"])
    return sw.upsert(first, top, ["user_id"], only_if_newer=True)


@query(LANDED + "SELECT DISTINCT t.o_orderkey FROM t JOIN s ON t.o_orderkey = s.o_orderkey")
def upsert_matched_keys(spark: SparkSession, sf: str) -> DataFrame:
    landed, fresh = _landed_and_new(spark, sf)
    return matched_keys(landed, fresh, ["o_orderkey"])


@query("SELECT conv_id, turn, role, text FROM conversations")
def upsert_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A composite key: opening turns landed with no text, then all turns merged."""
    turns, name = table(spark, sf, "conversations"), f"{scratch_database(spark)}.turns"
    sw.load(turns.filter("turn < 2").withColumn("text", F.lit("")), name, keys=["conv_id", "turn"])
    sw.load(turns, name, "upsert", keys=["conv_id", "turn"])
    return spark.table(name)


@query("""
SELECT event_type, user_id, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k
FROM events GROUP BY event_type, user_id
""")
def typed_view_over_shredded_files(spark: SparkSession, sf: str) -> DataFrame:
    """An aggregate over a stored view: the scan reads three paths of the VARIANT."""
    events, database = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", F.parse_json("props").alias("props")), scratch_database(spark)
    properties = {"props": {"type": "object", "properties": {"k": {"type": "integer"}}}}
    name = _load(spark, database, log_of(spark, events, spec_of(events, "events", **properties)), generate_view=True)
    rows = spark.table(f"{name}_view")
    return rows.groupBy("event_type", "user_id").agg(F.count("*").alias("n"), F.sum("props.k").alias("k"))


# ---- table loads ----------------------------------------------------------


def _load(spark: SparkSession, database: str, lines: DataFrame, as_of: dt.datetime = AS_OF, **settings) -> str:
    """Load lines and return the name of the first table."""
    results, _ = sw.load_messages(spark, lines, {"database": database, **settings}, as_of)
    return results[0].table


def _month(n: int) -> dt.datetime:
    return dt.datetime(2024, n, 1, 6, tzinfo=dt.timezone.utc)


def _plain_table(spark: SparkSession, name: str, *drop: str) -> DataFrame:
    return plain(spark.table(name).drop(*METADATA, *drop))


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def append_load(spark: SparkSession, sf: str) -> DataFrame:
    """The same log appended twice."""
    orders = table(spark, sf, "orders")
    lines, database = log_of(spark, orders, spec_of(orders, "orders", ["o_orderkey"])), scratch_database(spark)
    _load(spark, database, lines, _month(1), denormalized=True)
    return _plain_table(spark, _load(spark, database, lines, _month(2), denormalized=True))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def overwrite_load(spark: SparkSession, sf: str) -> DataFrame:
    """The second load replaces the first, with a schema of its own."""
    customer, database = table(spark, sf, "customer"), scratch_database(spark)
    old = customer.select("c_custkey", "c_acctbal")
    new = customer.select("c_custkey", "c_name", "c_mktsegment")
    _load(spark, database, log_of(spark, old, spec_of(old, "customer")), _month(1), denormalized=True)
    lines = log_of(spark, new, spec_of(new, "customer"))
    return _plain_table(spark, _load(spark, database, lines, _month(2), denormalized=True, overwrite="cust*"))


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal, TIMESTAMP '2024-03-01 12:00:00' AS _sdc_batched_at FROM supplier")
def bulk_load(spark: SparkSession, sf: str) -> DataFrame:
    """A log on disk, loaded typed."""
    supplier = table(spark, sf, "supplier")
    parts = [schema_line(spark, spec_of(supplier, "supplier", ["s_suppkey"])), record_lines(supplier, "supplier")]
    paths = log_parts(written_log(spark, parts), 2)
    results, _ = sw.load_messages(spark, paths, {"database": scratch_database(spark), "denormalized": True}, AS_OF)
    rows = plain(spark.table(results[0].table).drop(*[c for c in METADATA if c != "_sdc_batched_at"]))
    return rows.withColumn("s_nationkey", F.col("s_nationkey").cast("int"))


@query("SELECT p_partkey, p_name, p_brand FROM part")
def bulk_load_batch_files(spark: SparkSession, sf: str) -> DataFrame:
    """A log that names gzip files of records instead of holding them."""
    part, folder = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"), scratch_path(spark, "batch")
    part.write.option("compression", "gzip").json(folder)
    files = sorted(spark.read.text(folder).inputFiles())
    batch = {"type": "BATCH", "stream": "part", "encoding": {"format": "jsonl", "compression": "gzip"}, "manifest": files}
    lines = schema_line(spark, spec_of(part, "part", ["p_partkey"])).union(
        spark.createDataFrame([(json.dumps(batch),)], "payload STRING")
    )
    return _plain_table(spark, _load(spark, scratch_database(spark), lines, denormalized=True))


@query("SELECT p_partkey, p_name, p_brand, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def bulk_load_parquet_files(spark: SparkSession, sf: str) -> DataFrame:
    """A log that names Parquet files; their schemas differ, and their columns are fitted to the declared ones."""
    part, folder = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice"), scratch_path(spark, "batch")
    odd = F.col("p_partkey") % 2 == 1
    part.filter(odd).withColumn("undeclared", F.lit(1)).write.parquet(f"{folder}/a")
    part.filter(~odd).withColumn("p_partkey", F.col("p_partkey").cast("int")).write.parquet(f"{folder}/b")
    messages = []
    for at in "ab":
        files = sorted(spark.read.parquet(f"{folder}/{at}").inputFiles())
        messages.append((json.dumps({"type": "BATCH", "stream": "part", "encoding": {"format": "parquet"}, "manifest": files}),))
    lines = schema_line(spark, spec_of(part, "part", ["p_partkey"])).union(spark.createDataFrame(messages, "payload STRING"))
    return _plain_table(spark, _load(spark, scratch_database(spark), lines, denormalized=True))


@query("""
SELECT o_orderkey, o_orderstatus, TIMESTAMP '2024-03-01 12:00:00' AS _sdc_batched_at FROM orders
""")
def bulk_load_fixed(spark: SparkSession, sf: str) -> DataFrame:
    """The same in the fixed shape."""
    orders = table(spark, sf, "orders")
    name = _load(spark, scratch_database(spark), log_of(spark, orders, spec_of(orders, "orders", ["o_orderkey"])))
    return plain(
        spark.table(name).selectExpr(
            "variant_get(data, '$.o_orderkey', 'bigint') AS o_orderkey",
            "variant_get(data, '$.o_orderstatus', 'string') AS o_orderstatus",
            "_sdc_batched_at",
        )
    )


@query("""
WITH t AS (SELECT user_id, event_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-16'
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
     s AS (SELECT user_id, event_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-16'
           QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT coalesce(s.user_id, t.user_id) AS user_id, coalesce(s.event_id, t.event_id) AS event_id,
       coalesce(s.event_type, t.event_type) AS event_type
FROM t FULL OUTER JOIN s ON s.user_id = t.user_id
""")
def upsert_dedupe_load(spark: SparkSession, sf: str) -> DataFrame:
    """Two extracts, each deduped to the newest event of a user and merged."""
    events, database = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts"), scratch_database(spark)
    spec = spec_of(events.drop("ts"), "events", ["user_id"])
    halves = events.filter("ts < TIMESTAMP_NTZ '2024-01-16'"), events.filter("ts >= TIMESTAMP_NTZ '2024-01-16'")
    for at, half in enumerate(halves):
        lines = schema_line(spark, spec).union(record_lines(half, "events", "ts"))
        name = _load(spark, database, lines, _month(at + 1), denormalized=True, upsert=True, dedupe_before_upsert=True)
    return _plain_table(spark, name)


@query("""
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1999-01-01' THEN o_totalprice + 1
            ELSE o_totalprice END AS o_totalprice,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN TIMESTAMP '2024-01-01 06:00:00'
            WHEN o_orderdate < TIMESTAMP '1999-01-01' THEN TIMESTAMP '2024-03-01 06:00:00'
            ELSE TIMESTAMP '2024-02-01 06:00:00' END AS _sdc_batched_at
FROM orders
""")
def upsert_touched_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads, then an upsert that rewrites only the partition that holds its keys."""
    orders, database = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"), scratch_database(spark)
    early = orders.filter("o_orderdate < TIMESTAMP_NTZ '1999-01-01'")
    late = orders.filter("o_orderdate >= TIMESTAMP_NTZ '1999-01-01'")
    again = early.filter("o_orderdate >= TIMESTAMP_NTZ '1998-01-01'").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for at, extract in enumerate((early, late, again)):
        rows = extract.drop("o_orderdate")
        lines = log_of(spark, rows, spec_of(rows, "orders", ["o_orderkey"]))
        name = _load(spark, database, lines, _month(at + 1), denormalized=True, upsert=True)
    return plain(spark.table(name).drop(*[c for c in METADATA if c != "_sdc_batched_at"]))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'not JSON, or a value does not fit its declared type' ELSE 'loaded' END AS outcome FROM orders
""")
def quarantine_bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows with a value of the wrong type go to the quarantine table, the others load."""
    orders, database = table(spark, sf, "orders"), scratch_database(spark)
    spec = spec_of(orders.select("o_orderkey", "o_totalprice"), "orders", ["o_orderkey"])
    price = F.when(F.col("o_orderstatus") == "P", F.lit("unknown"))
    good = record_lines(orders.filter("o_orderstatus <> 'P'").select("o_orderkey", "o_totalprice"), "orders")
    bad = record_lines(orders.filter("o_orderstatus = 'P'").select("o_orderkey", price.alias("o_totalprice")), "orders")
    name = _load(spark, database, schema_line(spark, spec).union(good).union(bad), denormalized=True, fail_fast=False)
    key = F.get_json_object("raw", "$.record.o_orderkey").cast("bigint").alias("o_orderkey")
    set_aside = spark.table(f"{database}.quarantine").filter("stream = 'orders'").select(key, F.col("reason").alias("outcome"))
    return spark.table(name).select("o_orderkey", F.lit("loaded").alias("outcome")).union(set_aside)


@query("""
SELECT c_custkey, c_name, NULL AS c_mktsegment, NULL AS c_acctbal FROM customer
UNION ALL SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer
""")
def evolve_add_column(spark: SparkSession, sf: str) -> DataFrame:
    """New columns are appended; rows loaded before read as null."""
    customer, database = table(spark, sf, "customer"), scratch_database(spark)
    for at, columns in enumerate((["c_custkey", "c_name"], ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"])):
        rows = customer.select(*columns)
        name = _load(spark, database, log_of(spark, rows, spec_of(rows, "customer")), _month(at + 1), denormalized=True)
    return _plain_table(spark, name)


@query("""
SELECT c_custkey, c_name AS name, NULL AS acctbal, c_mktsegment AS segment, NULL AS nation FROM customer
UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment, CAST(c_nationkey AS BIGINT) FROM customer
""")
def evolve_nested_field(spark: SparkSession, sf: str) -> DataFrame:
    """A struct, and a struct in an array, get new fields; rows loaded before read as null."""
    customer, database = table(spark, sf, "customer"), scratch_database(spark)
    nation = F.col("c_nationkey").cast("bigint").alias("nation")
    shapes = (
        (F.struct(F.col("c_name").alias("name")), F.array(F.struct(F.col("c_mktsegment").alias("segment")))),
        (F.struct(F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal")), F.array(F.struct(F.col("c_mktsegment").alias("segment"), nation))),
    )
    for at, (who, what) in enumerate(shapes):
        rows = customer.select("c_custkey", who.alias("who"), what.alias("what"))
        name = _load(spark, database, log_of(spark, rows, spec_of(rows, "customer")), _month(at + 1), denormalized=True)
    first = F.col("what")[0]
    return spark.table(name).select("c_custkey", "who.name", "who.acctbal", first["segment"].alias("segment"), first["nation"].alias("nation"))


@query("SELECT o_orderkey, o_totalprice, o_orderstatus = 'F' AS finished, CAST(1 AS BIGINT) AS copies, 'done' AS bookmark FROM orders")
def retry_after_publish(spark: SparkSession, sf: str) -> DataFrame:
    """A load that is repeated after its table was published and before its bookmark was kept adds nothing."""
    orders, database = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "F").alias("finished")), scratch_database(spark)
    parts = [schema_line(spark, spec_of(orders, "orders", ["o_orderkey"])), record_lines(orders, "orders"), state_line(spark, {"at": "done"})]
    paths, state = log_parts(written_log(spark, parts), 3), scratch_path(spark, "state")
    for at, more in ((1, {}), (2, {"state_path": state})):
        sw.load_messages(spark, paths, {"database": database, "denormalized": True, **more}, _month(at))
    bookmark = F.lit(json.loads(sw.read_state(spark, state))["at"]).alias("bookmark")
    rows = spark.table(f"{database}.orders").groupBy("o_orderkey", "o_totalprice", "finished").agg(F.count("*").alias("copies"))
    return rows.withColumn("bookmark", bookmark)


@query("SELECT o_orderkey, o_custkey, true AS bounded FROM orders")
def batch_sizing(spark: SparkSession, sf: str) -> DataFrame:
    """No file of the table holds more rows than ``batch_size``."""
    orders, most = table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 500
    name = _load(spark, scratch_database(spark), log_of(spark, orders, spec_of(orders, "orders")), denormalized=True, batch_size=most)
    rows = spark.table(f"{name}__v1").select("o_orderkey", "o_custkey", F.input_file_name().alias("file"))
    files = rows.groupBy("file").agg((F.count("*") <= most).alias("bounded"))
    return rows.join(files, "file").drop("file")


@query("SELECT o_orderkey, o_totalprice, o_orderstatus = 'F' AS finished, o_orderstatus AS status FROM orders")
def load_quoted_scalars(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers and booleans that stand in quotes load as what they are declared to be; text stays text."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", (F.col("o_orderstatus") == "F").alias("finished"), F.col("o_orderstatus").alias("status"))
    price = F.regexp_replace(F.col("o_totalprice").cast("decimal(18,6)").cast("string"), r"\.?0+$", "")
    quoted = orders.select(F.col("o_orderkey").cast("string"), price.alias("o_totalprice"), F.col("finished").cast("string"), "status")
    lines = schema_line(spark, spec_of(orders, "orders", ["o_orderkey"])).union(record_lines(quoted, "orders"))
    return _plain_table(spark, _load(spark, scratch_database(spark), lines, denormalized=True))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 1 AS tables FROM customer")
def create_if_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Creating a table that exists changes nothing."""
    customer, database = table(spark, sf, "customer"), scratch_database(spark)
    first = sw.LandingTable.create(spark, f"{database}.customer", customer.schema, "month", "customers")
    first.append(spark, customer).publish(spark)
    again = sw.LandingTable.create(spark, f"{database}.customer", customer.schema, "month", "customers")
    made = spark.sql(f"SHOW TABLES IN {database}").filter("tableName LIKE 'customer__v%'").count()
    return spark.table(again.name).withColumn("tables", F.lit(made))


@query("""
SELECT event_id, user_id, event_type, value, ts FROM events
""")
def generate_view(spark: SparkSession, sf: str) -> DataFrame:
    """The stored view over a fixed table."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    name = _load(spark, scratch_database(spark), log_of(spark, events, spec_of(events, "events", ["event_id"])), generate_view=True)
    return plain(spark.table(f"{name}_view"))


@query("SELECT event_id, user_id FROM events")
def generate_view_two_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Two columns of the view read two columns of the file."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    name = _load(spark, scratch_database(spark), log_of(spark, events, spec_of(events, "events", ["event_id"])), generate_view=True)
    return spark.table(f"{name}_view").select("event_id", "user_id")


@query("""
SELECT o_orderkey, o_totalprice FROM orders
UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem
UNION ALL SELECT c_custkey, c_acctbal FROM customer
UNION ALL SELECT s_suppkey, s_acctbal FROM supplier
""")
def load_many_streams(spark: SparkSession, sf: str) -> DataFrame:
    """A log of four streams: split by stream once, then loaded table by table."""
    columns = {
        "orders": ("o_orderkey", "o_totalprice"), "lineitem": ("l_orderkey", "l_extendedprice"),
        "customer": ("c_custkey", "c_acctbal"), "supplier": ("s_suppkey", "s_acctbal"),
    }
    lines = None
    for name, pair in columns.items():
        rows = table(spark, sf, name).select(*pair)
        part = log_of(spark, rows, spec_of(rows, name))
        lines = part if lines is None else lines.union(part)
    results, _ = sw.load_messages(spark, lines, {"database": scratch_database(spark), "denormalized": True}, AS_OF)
    out = None
    for result in results:
        key, value = columns[result.stream]
        rows = spark.table(result.table).select(F.col(key).alias("o_orderkey"), F.col(value).alias("o_totalprice"))
        out = rows if out is None else out.union(rows)
    return out


# ---- layout, expiry and staging -------------------------------------------


def _landed_by_date(spark: SparkSession, df: DataFrame, at: str, grain: str) -> sw.LandingTable:
    """A table whose rows were batched at the given column."""
    rows = df.withColumn("_sdc_batched_at", F.col(at).cast("timestamp"))
    landed = sw.LandingTable.create(spark, f"{scratch_database(spark)}.landed", rows.schema, grain)
    landed = landed.append(spark, rows)
    landed.publish(spark)
    return landed


@query("SELECT strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS part, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1")
def partition_by_month(spark: SparkSession, sf: str) -> DataFrame:
    landed = _landed_by_date(spark, table(spark, sf, "orders"), "o_orderdate", "month")
    return landed.rows(spark).groupBy(F.col(landed.part).cast("string").alias("part")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("SELECT strftime(ts, '%Y-%m-%d') AS part, count(*) AS n, sum(event_id)::BIGINT AS keys FROM events GROUP BY 1")
def partition_by_day(spark: SparkSession, sf: str) -> DataFrame:
    landed = _landed_by_date(spark, table(spark, sf, "events"), "ts", "day")
    return landed.rows(spark).groupBy(F.col(landed.part).cast("string").alias("part")).agg(F.count("*").alias("n"), F.sum("event_id").alias("keys"))


@query("SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10 12:00:00' AND ts < TIMESTAMP '2024-01-12 06:00:00'")
def partition_pruned_read(spark: SparkSession, sf: str) -> DataFrame:
    """A time range opens only the partitions that can hold it."""
    landed = _landed_by_date(spark, table(spark, sf, "events"), "ts", "day")
    start, end = (dt.datetime(2024, 1, d, h, tzinfo=dt.timezone.utc) for d, h in ((10, 12), (12, 6)))
    return sw.read_between(spark, landed.name, start, end).select("event_id", "user_id")


@query("SELECT o_orderkey, o_orderdate FROM orders WHERE date_trunc('month', o_orderdate) >= TIMESTAMP '2001-08-15' - INTERVAL 730 DAY")
def expire_partitions(spark: SparkSession, sf: str) -> DataFrame:
    landed = _landed_by_date(spark, table(spark, sf, "orders"), "o_orderdate", "month")
    sw.expire_partitions(spark, landed.name, 730, dt.datetime(2001, 8, 15, tzinfo=dt.timezone.utc))
    return spark.table(landed.name).select("o_orderkey", "o_orderdate")


@query("SELECT l_orderkey, l_partkey, l_quantity FROM lineitem")
def cluster_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Rows written in narrow key ranges."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    path = scratch_path(spark, "clustered")
    sw.cluster_layout(lines, ["l_partkey", "l_orderkey"]).write.parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


@query("SELECT c_custkey, c_name FROM customer")
def expire_staging(spark: SparkSession, sf: str) -> DataFrame:
    """Staged rows of last month are swept, those of today stay."""
    customer, root = table(spark, sf, "customer").select("c_custkey", "c_name"), scratch_path(spark, "staging")
    for made in (_month(1), _month(2), AS_OF):
        customer.write.parquet(f"{root}/{sw.staging_name('customer', made)}")
    sw.expire_staging(spark, root, AS_OF)
    return spark.read.schema(customer.schema).parquet(f"{root}/*")


@query("SELECT event_id, ts, user_id, value FROM events")
def stage_to_lake(spark: SparkSession, sf: str) -> DataFrame:
    """Table rows staged as gzip JSON and read back whole."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "value")
    root = scratch_path(spark, "lake")
    sw.stage_to_lake(events, root, "Site-Events", "batch-1", AS_OF)
    return plain(sw.lake_load(spark, root, "Site-Events", events.schema))


@query("SELECT p_partkey, p_name, p_brand, p_retailprice FROM part")
def lake_load(spark: SparkSession, sf: str) -> DataFrame:
    """A log staged to the lake, then loaded from there."""
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    lines = log_of(spark, part, spec_of(part, "part", ["p_partkey"]))
    root = scratch_path(spark, "lake")
    return _plain_table(spark, _load(spark, scratch_database(spark), lines, denormalized=True, method="lake_stage", lake_root=root))


@query(LANDED + """
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
       CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END AS o_totalprice
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey
""")
def lake_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Two extracts staged in the lake, each merged from there."""
    database, root = scratch_database(spark), scratch_path(spark, "lake")
    for at, extract in enumerate(_landed_and_new(spark, sf)):
        rows = extract.select("o_orderkey", "o_orderstatus", "o_totalprice")
        lines = log_of(spark, rows, spec_of(rows, "orders", ["o_orderkey"]))
        name = _load(spark, database, lines, _month(at + 1), denormalized=True, upsert=True, method="lake_stage", lake_root=root)
    return _plain_table(spark, name)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def compact_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Four loads of one period, folded into one partition; every row stays."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    name = f"{scratch_database(spark)}.orders"
    quarter = F.pmod(F.xxhash64("o_orderkey"), F.lit(4))
    for n in range(4):
        sw.load(orders.filter(quarter == n), name)
    sw.compact(spark, name)
    return plain(spark.table(name))


# ---- streaming ------------------------------------------------------------


def _event_log(spark: SparkSession, sf: str) -> tuple[str, StreamSpec]:
    """A folder of message logs: a schema, three files of events in time order, and bookmarks."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value", "ts")
    spec = spec_of(events, "events", ["user_id"])
    root = scratch_path(spark, "incoming")
    schema_line(spark, spec).coalesce(1).write.text(f"{root}/0")
    first, second = (f"TIMESTAMP_NTZ '{day}'" for day in ("2024-01-11", "2024-01-21"))
    parts = [f"ts < {first} OR ts IS NULL", f"ts >= {first} AND ts < {second}", f"ts >= {second}"]
    for at, part in enumerate(parts, 1):
        lines = record_lines(events.filter(part), "events", "ts").union(state_line(spark, {"upto": at}))
        lines.coalesce(1).write.text(f"{root}/{at}")  # one file a part: micro-batches follow time
    return f"{root}/*", spec


@query("SELECT event_id, user_id, event_type, value, ts FROM events")
def stream_append(spark: SparkSession, sf: str) -> DataFrame:
    source, spec = _event_log(spark, sf)
    path = scratch_path(spark, "appended")
    config = sw.LoadConfig(denormalized=True)
    sw.stream_append(spark, source, spec, config, path, scratch_path(spark, "checkpoint"), 1, clock=lambda: AS_OF).awaitTermination()
    return plain(sw.read_appended(spark, path).drop(*METADATA, "_sdc_batched_month"))


@query("""
SELECT event_id, CASE WHEN user_id % 7 = 0 THEN 'not JSON, or a value does not fit its declared type' ELSE 'loaded' END AS outcome,
       CAST(3 AS BIGINT) AS bookmark FROM events
""")
def stream_append_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, rejects and bookmark of an append stream, written together batch by batch; a restart adds nothing."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    spec = spec_of(events.select("event_id", "user_id"), "events", ["event_id"])
    root, path, checkpoint = (scratch_path(spark, n) for n in ("incoming", "appended", "checkpoint"))
    bad = F.when(F.col("user_id") % 7 == 0, F.concat(F.lit("user "), F.col("user_id").cast("string"))).otherwise(F.col("user_id").cast("string"))
    user = F.when(F.col("user_id") % 7 == 0, F.concat(F.lit('"'), bad, F.lit('"'))).otherwise(bad)
    line = F.format_string('{"type":"RECORD","stream":"events","record":{"event_id":%d,"user_id":%s}}', "event_id", user)
    days = F.greatest(F.lit(1), F.least(F.lit(3), F.ceil(F.dayofmonth("ts") / 10)))
    for n in (1, 2, 3):
        lines = events.filter(F.coalesce(days, F.lit(1)) == n).select(line.alias("payload")).union(state_line(spark, {"upto": n}))
        lines.coalesce(1).write.text(f"{root}/{n}")
    config = sw.LoadConfig(denormalized=True, fail_fast=False)
    for _ in range(2):
        sw.stream_append(spark, f"{root}/*", spec, config, path, checkpoint, 1, clock=lambda: AS_OF).awaitTermination()
    bookmark = F.lit(json.loads(sw.appended_state(spark, path))["upto"]).cast("bigint").alias("bookmark")
    key = F.get_json_object("raw", "$.record.event_id").cast("bigint").alias("event_id")
    loaded = sw.read_appended(spark, path).select("event_id", F.lit("loaded").alias("outcome"), bookmark)
    return loaded.union(sw.read_rejected(spark, path).select(key, F.col("reason").alias("outcome"), bookmark))


@query("""
SELECT event_id, user_id, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN value END AS value,
       CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN event_type END AS kind
FROM events
""")
def stream_evolve_on_restart(spark: SparkSession, sf: str) -> DataFrame:
    """A stream whose schema grows between two runs, by a column and by a nested field."""
    events = table(spark, sf, "events")
    root, database, checkpoint = scratch_path(spark, "incoming"), scratch_database(spark), scratch_path(spark, "checkpoint")
    wide = events.select("event_id", "ts", "value", F.struct("user_id", F.col("event_type").alias("kind")).alias("who"))
    narrow = events.select("event_id", "ts", F.struct("user_id").alias("who"))
    later = "ts >= TIMESTAMP_NTZ '2024-01-16'"
    for at, (rows, part) in enumerate(((narrow, f"NOT coalesce({later}, false)"), (wide, later))):
        rows = rows.filter(part).drop("ts")
        schema_line(spark, spec_of(rows, "events", ["event_id"])).union(record_lines(rows, "events")).coalesce(1).write.text(f"{root}/{at}")
        config = sw.LoadConfig(database=database, denormalized=True)
        sw.stream_load(spark, f"{root}/*", config, checkpoint, 1, clock=lambda: AS_OF).awaitTermination()
    return spark.table(f"{database}.events").select("event_id", "who.user_id", "value", "who.kind")


@query("SELECT event_id, user_id, event_type, value, ts FROM events")
def stream_commit_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Micro-batches committed whole; a restart adds nothing."""
    source, _ = _event_log(spark, sf)
    database, checkpoint = scratch_database(spark), scratch_path(spark, "checkpoint")
    config = sw.LoadConfig(database=database, denormalized=True)
    for _ in range(2):
        sw.stream_load(spark, source, config, checkpoint, 1, clock=lambda: AS_OF).awaitTermination()
    return _plain_table(spark, f"{database}.events")


@query("""
SELECT event_id, user_id, event_type, value, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Each micro-batch is deduped and merged: the newest event of every user."""
    source, _ = _event_log(spark, sf)
    database = scratch_database(spark)
    config = sw.LoadConfig(database=database, denormalized=True, upsert=True, dedupe_before_upsert=True)
    sw.stream_load(spark, source, config, scratch_path(spark, "checkpoint"), clock=lambda: AS_OF).awaitTermination()
    return _plain_table(spark, f"{database}.events")


# ---- flagship -------------------------------------------------------------


@query("""
SELECT o_orderkey AS order_key, o_custkey AS cust_key, nullif(o_orderstatus, 'P') AS order_status, o_totalprice AS total_price,
       o_orderdate AS order_date
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, 0.0, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
""")
def load_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Messages to rows: scan, schema, typed projection, renaming, metadata, dedupe, merge."""
    landed, fresh = _landed_and_new(spark, sf)
    rules = {"snake_case": True}
    names = ["orderKey", "custKey", "orderStatus", "totalPrice", "orderDate"]
    target = sw.rename(landed.toDF(*names), rules).withColumn("order_date", F.col("order_date").cast("timestamp"))
    source = fresh.toDF(*names)
    msgs = sw.as_messages(log_of(spark, source, spec_of(source, "orders", ["orderKey"]), "orderDate"))
    spec = sw.stream_specs(msgs)["orders"]
    rows = sw.project_denormalized(msgs, spec, rules, as_of=AS_OF)
    latest = sw.dedupe_latest(rows, sw.key_names(spec.key_properties, rules))
    return plain(sw.upsert(target, latest, ["order_key"]))
