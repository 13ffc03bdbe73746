"""Sources: message logs, batch files, the lake, and what is read off a log."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sluiceway as sw
from sluiceway.session import scratch_path
from sluiceway.sources import messages

from .registry import query
from .render import (
    AS_OF, log_parts, record_lines, schema_line, spec_of, state_line, table, written_log,
)


@query("""
SELECT 'RECORD' AS type, 'orders' AS stream, o_orderkey, o_orderpriority FROM orders
UNION ALL SELECT 'SCHEMA', 'orders', -1, NULL
UNION ALL SELECT 'STATE', NULL, -1, NULL
""")
def scan_messages(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    spec = spec_of(orders, "orders", ["o_orderkey"])
    parts = [schema_line(spark, spec), record_lines(orders, "orders"), state_line(spark, {"at": 1})]
    msgs = sw.read_messages(spark, log_parts(written_log(spark, parts), 3))
    record = F.from_json("payload", "record STRUCT<o_orderkey: BIGINT, o_orderpriority: STRING>")["record"]
    return msgs.select("type", "stream", F.coalesce(record["o_orderkey"], F.lit(-1)).alias("o_orderkey"), record["o_orderpriority"].alias("o_orderpriority"))


STREAMS = {
    "orders": ("o_orderkey", "o_orderpriority"),
    "customer": ("c_custkey", "c_name"),
    "supplier": ("s_suppkey", "s_name"),
    "part": ("p_partkey", "p_name"),
    "nation": ("n_nationkey", "n_name"),
}


def mixed_log(spark: SparkSession, sf: str, without_schema: tuple[str, ...] = ()) -> DataFrame:
    """Several tables interleaved in one log."""
    lines = None
    for name, columns in STREAMS.items():
        df = table(spark, sf, name).select(*columns)
        part = record_lines(df, name)
        if name not in without_schema:
            part = schema_line(spark, spec_of(df, name, [columns[0]])).union(part)
        lines = part if lines is None else lines.union(part)
    return lines


@query(" UNION ALL ".join(
    f"SELECT '{name}' AS stream, CAST({key} AS BIGINT) AS key, {label} AS label FROM {name}"
    for name, (key, label) in STREAMS.items()
))
def demux_streams(spark: SparkSession, sf: str) -> DataFrame:
    msgs = sw.as_messages(mixed_log(spark, sf))
    out = None
    for name, spec in sw.stream_specs(msgs).items():
        rows = sw.project_denormalized(sw.records_of(msgs, name), spec)
        key, label = STREAMS[name]
        rows = rows.select(F.lit(name).alias("stream"), F.col(key).alias("key"), F.col(label).alias("label"))
        out = rows if out is None else out.union(rows)
    return out


@query("""
SELECT 'orders' AS stream, count(*) AS records FROM orders
UNION ALL SELECT 'nation', count(*) FROM nation
""")
def unknown_streams(spark: SparkSession, sf: str) -> DataFrame:
    msgs = sw.as_messages(mixed_log(spark, sf, ("orders", "nation")))
    return sw.unknown_streams(msgs, list(sw.stream_specs(msgs)))


@query("SELECT * FROM part")
def scan_batch_files(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    folder = scratch_path(spark, "batch")
    part.write.option("compression", "gzip").json(folder)
    batch = {
        "type": "BATCH", "stream": "part", "encoding": {"format": "jsonl", "compression": "gzip"},
        "manifest": sorted(spark.read.text(folder).inputFiles()),
    }
    msgs = sw.as_messages(spark.createDataFrame([(json.dumps(batch),)], "payload STRING"))
    files = [r.file for r in sw.batch_manifest(msgs).filter("stream = 'part'").collect()]
    rows, _ = sw.split_corrupt(sw.read_batch_files(spark, files, spec_of(part, "part")))
    return rows.withColumn("p_size", F.col("p_size").cast("int"))


def _staged_events(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    events = table(spark, sf, "events").withColumn("_sdc_extracted_at", F.col("ts").cast("timestamp"))
    root = scratch_path(spark, "lake")
    sw.stage_to_lake(events, root, "Events", "b1", AS_OF, "bench")
    return root, events


@query("SELECT event_id, ts, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d') AS extracted_date, 'b1' AS batch_id FROM events")
def scan_lake(spark: SparkSession, sf: str) -> DataFrame:
    root, events = _staged_events(spark, sf)
    rows, _ = sw.split_corrupt(sw.read_lake(spark, root, "Events", events.schema, dataset="bench"))
    return rows.drop("_sdc_extracted_at").withColumn("extracted_date", F.col("extracted_date").cast("string"))


@query("SELECT event_id, user_id, value FROM events WHERE CAST(ts AS DATE) IN (DATE '2024-01-05', DATE '2024-01-06')")
def scan_lake_dates(spark: SparkSession, sf: str) -> DataFrame:
    root, events = _staged_events(spark, sf)
    rows = sw.read_lake(spark, root, "Events", events.schema, ["2024-01-05", "2024-01-06"], dataset="bench")
    return rows.select("event_id", "user_id", "value")


@query("SELECT max(event_id) AS bookmark FROM events")
def latest_state(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").orderBy("event_id")
    states = events.select(
        F.concat(F.lit('{"type":"STATE","value":{"bookmark":'), F.col("event_id").cast("string"), F.lit("}}")).alias("payload")
    )
    msgs = sw.read_messages(spark, log_parts(written_log(spark, [states]), 1))
    return sw.latest_state(msgs).select(F.get_json_object("state", "$.bookmark").cast("bigint").alias("bookmark"))


@query("""
SELECT 'orders' AS stream, 'o_orderkey' AS key, 'number' AS kind
""")
def first_schema_wins(spark: SparkSession, sf: str) -> DataFrame:
    """A log that repeats its schema after every batch, later ones with another type."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    first = spec_of(orders, "orders", ["o_orderkey"])
    later = spec_of(orders, "orders", ["o_totalprice"], o_totalprice={"type": "string"})
    repeats = orders.select(F.lit(schema_line(spark, later).first().payload).alias("payload"))
    parts = [schema_line(spark, first), record_lines(orders, "orders"), repeats]
    msgs = sw.read_messages(spark, log_parts(written_log(spark, parts), 3))
    found = messages.declared_schemas(msgs)
    return found.select(
        "stream",
        F.col("key_properties")[0].alias("key"),
        F.get_json_object("schema", "$.properties.o_totalprice.type[0]").alias("kind"),
    )


@query("""
SELECT 'table_' || CAST(page_id AS VARCHAR) AS label, regexp_replace(lower(url), '[^a-z0-9_]', '_', 'g') AS table_name FROM pages
""")
def normalize_table_name(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    return pages.select(F.concat(F.lit("table_"), F.col("page_id").cast("string")).alias("label"), sw.table_name("url").alias("table_name"))


@query("""
SELECT c_custkey, c_mktsegment, c_mktsegment <> 'BUILDING' AND (c_mktsegment LIKE 'B%' OR c_mktsegment LIKE '%I%')
       OR c_mktsegment = 'MACHINERY' AS selected FROM customer
""")
def select_streams(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    return customer.select("c_custkey", "c_mktsegment", sw.selects("B*, *I*, !BUILDING, M?CHINERY", "c_mktsegment").alias("selected"))


@query("""
SELECT CASE WHEN stream IN ('orders', 'customer') THEN 'upsert' WHEN stream = 'part' THEN 'overwrite' ELSE 'append' END AS mode,
       CAST(sum(n) AS BIGINT) AS records
FROM (SELECT 'orders' AS stream, count(*) AS n FROM orders UNION ALL SELECT 'customer', count(*) FROM customer
      UNION ALL SELECT 'supplier', count(*) FROM supplier UNION ALL SELECT 'part', count(*) FROM part
      UNION ALL SELECT 'nation', count(*) FROM nation)
GROUP BY 1
""")
def mode_resolution(spark: SparkSession, sf: str) -> DataFrame:
    msgs = sw.as_messages(mixed_log(spark, sf))
    config = sw.LoadConfig(denormalized=True, upsert="orders,customer", overwrite=["*", "!nation", "!supplier"])
    modes = {n: sw.resolve_mode(s, config) for n, s in sw.stream_specs(msgs).items()}
    mode = F.create_map(*[F.lit(x) for pair in modes.items() for x in pair])[F.col("stream")]
    return msgs.filter("type = 'RECORD'").groupBy(mode.alias("mode")).agg(F.count("*").alias("records"))

