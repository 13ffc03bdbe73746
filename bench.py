"""Headline workloads, timed. Prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Inputs are
written before the clock starts; every figure is the median of ``BENCH_REPS``
runs after one warm-up.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import sluiceway as sw
from sluiceway.session import scratch_path
from workloads import render

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPS = int(os.environ.get("BENCH_REPS", "3"))
ONLY = set(filter(None, os.environ.get("BENCH_ONLY", "").split(",")))
AS_OF = render.AS_OF


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("sluiceway-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def drain(df: DataFrame) -> None:
    """Compute every row and column, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


class Bench:
    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.seconds: dict[str, float] = {}
        self.rows: dict[str, int] = {}

    def run(self, name: str, work, rows: int, before=None) -> None:
        """Time ``work``; it gets what ``before`` makes anew for each run, outside the clock."""
        if ONLY and name not in ONLY:
            return
        times = []
        for _ in range(REPS + 1):
            given = [before()] if before else []
            start = time.perf_counter()
            work(*given)
            times.append(time.perf_counter() - start)
        self.seconds[name] = round(statistics.median(times[1:]), 3)
        self.rows[name] = rows

    def log(self, df: DataFrame, stream: str, keys: list[str], files: int) -> tuple[list[str], int]:
        """A frame written as a message log: paths and record count."""
        spec = render.spec_of(df, stream, keys)
        records = render.record_lines(df.repartition(files), stream)
        root = render.written_log(self.spark, [render.schema_line(self.spark, spec), records])
        return render.log_parts(root, 2), df.count()


def load_benches(b: Bench) -> None:
    spark = b.spark
    lineitem = render.table(spark, SF, "lineitem")
    paths, n = b.log(lineitem, "lineitem", ["l_orderkey", "l_linenumber"], 8)

    def load(**settings) -> str:
        config = {"database": render.scratch_database(spark), **settings}
        results, _ = sw.load_messages(spark, paths, config, AS_OF)
        assert results[0].rows == n
        return results[0].table

    b.run("messages_denorm_append", lambda: load(denormalized=True), n)
    b.run("messages_fixed_append", lambda: load(denormalized=False), n)
    view = load(denormalized=False, generate_view=True) + "_view"
    b.run("typed_view_all_columns", lambda: drain(spark.table(view)), n)
    b.run("typed_view_2_columns", lambda: drain(spark.table(view).select("l_orderkey", "l_quantity")), n)
    b.run(
        "lake_stage_then_load",
        lambda: load(denormalized=True, method="lake_stage", lake_root=scratch_path(spark, "lake")),
        n,
    )


def merge_benches(b: Bench) -> None:
    spark = b.spark
    orders = render.table(spark, SF, "orders")
    path = scratch_path(spark, "orders")
    orders.withColumn("o_totalprice", F.lit(0.0)).repartition(8).write.parquet(path)
    target, n = spark.read.parquet(path), orders.count()
    for percent in (1, 10, 100):
        changed = scratch_path(spark, f"changed{percent}")
        orders.filter(F.col("o_orderkey") < n * percent // 100).repartition(8).write.parquet(changed)
        source = spark.read.parquet(changed)
        latest = lambda source=source: sw.dedupe_latest(source, ["o_orderkey"], ["o_orderdate"])
        b.run(f"dedupe_upsert_{percent}pct", lambda: drain(sw.upsert(target, latest(), ["o_orderkey"])), n)

    def month(m: int) -> dt.datetime:
        return dt.datetime(2024, m, 1, tzinfo=dt.timezone.utc)

    parts = [
        orders.filter((F.col("o_orderkey") % 8) == m).withColumn("_sdc_batched_at", F.lit(month(m + 1))) for m in range(8)
    ]

    def landed() -> sw.LandingTable:
        table = sw.LandingTable.create(spark, f"{render.scratch_database(spark)}.orders", parts[0].schema)
        for part in parts:
            table = table.append(spark, part).publish(spark)
        return table

    for name, changed in (
        ("merge_one_partition_of_8", parts[0]),
        ("merge_all_partitions", orders.withColumn("_sdc_batched_at", F.lit(month(9)))),
    ):
        staged = scratch_path(spark, "staged")
        changed.withColumn("o_totalprice", F.lit(1.0)).write.parquet(staged)
        source = spark.read.parquet(staged)
        b.run(name, lambda table, source=source: table.merge(spark, source, ["o_orderkey"]).publish(spark), n, landed)


def stream_benches(b: Bench) -> None:
    spark = b.spark
    events = render.table(spark, SF, "events")
    spec = render.spec_of(events, "events", ["event_id"])
    source = scratch_path(spark, "incoming")
    render.record_lines(events.repartition(16), "events", "ts").write.text(source)
    n = events.count()
    config = sw.LoadConfig(denormalized=True)

    def append() -> None:
        out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "cp")
        sw.stream_append(spark, source, spec, config, out, checkpoint, 8, clock=lambda: AS_OF).awaitTermination()

    b.run("stream_append", append, n)


def wide_bench(b: Bench) -> None:
    """Every order as a record of 150 columns, in gzip files."""
    spark = b.spark
    orders = render.table(spark, SF, "orders")
    kinds = (F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderpriority"), F.col("o_orderdate"))
    wide = orders.select("*", *[kinds[i % 4].alias(f"col_{i}") for i in range(150 - len(orders.columns))])
    folder = scratch_path(spark, "wide")
    options = {"compression": "gzip", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}
    wide.repartition(8).write.options(**options).json(folder)
    spec = render.spec_of(wide, "wide", ["o_orderkey"])

    def load() -> None:
        rows, _ = sw.split_corrupt(sw.read_batch_files(spark, folder, spec))
        sw.stamp_metadata(rows, AS_OF).write.parquet(scratch_path(spark, "wide-out"))

    b.run("wide_150_columns_batch_files", load, wide.count())


def main() -> None:
    bench = Bench(session())
    for group in (load_benches, merge_benches, stream_benches, wide_bench):
        group(bench)
    total = round(sum(bench.seconds.values()), 3)
    rates = {name: int(bench.rows[name] / s) for name, s in bench.seconds.items()}
    print(json.dumps({
        "metric": "total_seconds", "value": total, "unit": "sec", "queries": bench.seconds, "sf": os.path.basename(SF.rstrip("/")),
        "rows_per_sec": rates, "cpus": int(CPUS), "reps": REPS,
    }))


if __name__ == "__main__":
    main()
