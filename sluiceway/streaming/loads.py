"""Structured Streaming loads of a growing folder of message logs."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Mapping
from dataclasses import asdict, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.names import table_name_of
from ..functions.types import StreamSpec
from ..operators.envelope import BATCH, GOOD, OUTCOME, PAYLOAD, REJECT, REJECTED, SEQ, STATE, STRAY
from ..plans.loads import LoadConfig, LoadResult, load_messages, mapped_spec, stream_rows
from ..plans.tables import LandingTable, partition_column, partition_value
from ..session import prepare_session, quoted
from ..sources.messages import LogFacts, log_facts, stream_lines, with_order

Clock = Callable[[], dt.datetime]


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _trigger(every: str | None) -> dict[str, Any]:
    return {"processingTime": every} if every else {"availableNow": True}


#: The partition of a folder that a micro-batch writes, beside the outcome and the period.
BATCH_ID = "__batch"


def stream_append(
    spark: SparkSession,
    source: str,
    spec: StreamSpec,
    config: LoadConfig | Mapping[str, Any],
    path: str,
    checkpoint: str,
    max_files: int | None = None,
    every: str | None = None,
    clock: Clock | None = None,
) -> StreamingQuery:
    """Append one declared stream to a Parquet folder, visible batch by batch.

    One job a batch writes rows, rejected rows and bookmarks, each to partitions of their own: see ``read_appended``,
    ``read_rejected`` and ``appended_state``. A batch that is replayed writes over its partitions, so each of the three is
    there exactly once. Lines that cannot be loaded stop the query under ``fail_fast``, and nothing of their batch shows;
    records of other streams are passed over. Rows carry the time of their micro-batch, which Spark keeps in the
    checkpoint, so a replay stamps alike; ``clock`` gives all rows of a run one time instead.
    """
    prepare_session(spark)
    config = LoadConfig.of(config)
    grain = config.partition_granularity
    at = _BATCH_TIME

    def write(batch: DataFrame, batch_id: int) -> None:
        first = batch.select(at).head()
        if first is None:
            return
        rows, _ = stream_rows(with_order(batch.drop(at)), spec, config, clock() if clock else first[0].astimezone(dt.timezone.utc), False, [spec.name])
        elsewhere = (F.col(OUTCOME) == STRAY) & F.coalesce(F.col(REJECT) == "a record without a schema", F.lit(False))
        rows = rows.filter(~elsewhere & (F.col(OUTCOME) != BATCH))
        if config.fail_fast:
            refuse = F.raise_error(F.concat(F.lit(f"{spec.name}: "), F.col(REJECT), F.lit(": "), F.col(PAYLOAD)))
            rows = rows.filter(F.when(F.col(OUTCOME).isin(GOOD, STATE), F.lit(True)).otherwise(refuse.cast("boolean")))
        beside = [F.when(F.col(OUTCOME) != GOOD, F.col(c)).alias(c) for c in (SEQ, PAYLOAD)]
        kept = rows.select(*[F.col(quoted(c)) for c in rows.columns if c not in (SEQ, PAYLOAD)], *beside)
        out = kept.withColumn(partition_column(grain), partition_value(grain)).withColumn(BATCH_ID, F.lit(batch_id))
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(OUTCOME, partition_column(grain), BATCH_ID)
        (writer.option("maxRecordsPerFile", config.batch_size) if config.batch_size else writer).parquet(path)

    return (
        stream_lines(spark, source, max_files, None if max_files else config.batch_bytes)
        .withColumn(at, F.current_timestamp())
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


_BATCH_TIME = "__at"


def _appended(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path).filter(F.col(OUTCOME) == outcome).drop(OUTCOME)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``stream_append`` has loaded, with the partition of their period."""
    return _appended(spark, path, GOOD).drop(SEQ, PAYLOAD, REJECT, BATCH_ID)


def read_rejected(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``stream_append`` has set aside: ``(raw, reason, batch)``."""
    bad = _appended(spark, path, REJECTED).unionByName(_appended(spark, path, STRAY))
    return bad.select(F.col(PAYLOAD).alias("raw"), F.col(REJECT).alias("reason"), F.col(BATCH_ID).alias("batch"))


def appended_state(spark: SparkSession, path: str) -> str | None:
    """The bookmark that ``stream_append`` has reached: the last one of the newest batch that has one."""
    newest = F.struct(F.col(BATCH_ID).cast("bigint"), F.col(SEQ))
    return _appended(spark, path, STATE).agg(F.max_by(REJECT, newest).alias("state")).first()["state"]


class _DeclaredStreams:
    """The history of schemas by batch, kept beside the checkpoint: later batches carry records only.

    The first schema of a stream in a run counts for that run, as in a batch load; the next run may bring a wider one. What
    a batch that declares streams was read with is noted before it is loaded, so a replay reads it alike, whichever run that is.
    """

    def __init__(self, spark: SparkSession, checkpoint: str) -> None:
        self.spark, self.path = spark, f"{checkpoint.rstrip('/')}/declared"
        self.by_batch: dict[int, dict[str, StreamSpec]] = {}
        self.run: dict[str, StreamSpec] = {}
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
            for row in spark.read.parquet(self.path).toLocalIterator():
                found = json.loads(row.spec)
                spec = StreamSpec(
                    found["name"], found["json_schema"], tuple(found["key_properties"]), tuple(found["bookmark_properties"])
                )
                self.by_batch.setdefault(int(row.batch), {})[spec.name] = spec

    def known(self, batch_id: int) -> dict[str, StreamSpec]:
        """The schemas that count for a batch: of each stream the last one noted up to it."""
        return {n: s for batch in sorted(self.by_batch) if batch <= batch_id for n, s in self.by_batch[batch].items()}

    def learn(self, lines: DataFrame, batch_id: int) -> LogFacts:
        """Facts of a batch, with the schemas that count for it."""
        found = log_facts(lines)
        noted = self.by_batch.get(batch_id)
        if noted is None and found.specs:
            noted = {n: self.run.get(n, s) for n, s in found.specs.items()}
            rows = [(json.dumps(asdict(s)),) for s in noted.values()]
            self.spark.createDataFrame(rows, "spec STRING").coalesce(1).write.mode("overwrite").parquet(
                f"{self.path}/batch={batch_id}"
            )
            self.by_batch[batch_id] = noted
        self.run.update(noted or {})
        return replace(found, specs=self.known(batch_id))


def stream_load(
    spark: SparkSession,
    source: str,
    config: LoadConfig | Mapping[str, Any],
    checkpoint: str,
    max_files: int | None = None,
    every: str | None = None,
    clock: Clock = _now,
    on_commit: Callable[[int, list[LoadResult], str | None], None] | None = None,
) -> StreamingQuery:
    """Load all streams of a growing log, any write mode; a micro-batch is the unit of commit.

    A batch takes ``max_files`` files, or ``batch_bytes`` of log by the settings. Schemas may grow from run to run: new columns and
    nested fields are added to the tables. Each table remembers the batch it was last published for, in the same catalog
    update as its data. A replayed batch skips the tables that have it already,
    and writes over what a dead attempt left in the others. The bookmark follows
    the tables.
    """
    prepare_session(spark)
    config = LoadConfig.of(config)
    declared = _DeclaredStreams(spark, checkpoint)

    def commit(batch: DataFrame, batch_id: int) -> None:
        lines = with_order(batch)
        found = declared.learn(lines, batch_id)
        query = checkpoint.rstrip("/")
        maps = dict(config.stream_maps)
        for name, spec in found.specs.items():
            if _committed(spark, spec, config, query) >= batch_id:
                maps[name] = None
        settings = replace(config, stream_maps=maps)
        results, bookmark = load_messages(
            spark, lines, settings, clock(), facts={"query": query, "batch": str(batch_id)}, found=found
        )
        if on_commit:
            on_commit(batch_id, results, bookmark)

    return (
        stream_lines(spark, source, max_files, None if max_files else config.batch_bytes)
        .writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def _committed(spark: SparkSession, spec: StreamSpec, config: LoadConfig, query: str) -> int:
    """The last batch of this query that a stream's table was published for, or -1."""
    if config.stream_maps.get(spec.name, {}) is None:
        return -1
    table = LandingTable.find(spark, f"{config.database}.{table_name_of(mapped_spec(spec, config).name)}")
    if table is None:
        return -1
    facts = table.begin(spark).facts  # an upsert that is finished only now brings its batch with it
    return int(facts.get("batch", -1)) if facts.get("query") == query else -1
