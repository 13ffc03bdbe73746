"""The load: message log in, published tables and bookmark out."""

from __future__ import annotations

import datetime as dt
import json
import threading
import warnings
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, fields, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import NameRules, key_names, rename_struct, table_name_of
from ..functions.numbers import json_value
from ..functions.selection import is_selected
from ..functions.types import METADATA_COLUMNS, StreamSpec, resolve_schema, to_struct
from ..operators.envelope import (
    BATCH,
    GOOD,
    HIDDEN,
    OUTCOME,
    PAYLOAD,
    REJECT,
    REJECTED,
    SEQ,
    STATE,
    STRAY,
    batch_records,
    project_denormalized,
    project_fixed,
    stray_reason,
)
from ..operators.mapping import ALIAS, FILTER, KEYS, apply_stream_map, flatten
from ..operators.merge import dedupe_latest
from ..operators.views import view_columns, view_statement
from ..session import files_of, prepare_session, quoted, quoted_table, remove_folder, scratch_root, sql_text
from ..sources.files import batch_files, lake_folder
from ..sources.messages import (
    HEAD,
    LogFacts,
    as_messages,
    log_facts,
    log_identity,
    parsed_once,
    read_lines,
    with_order,
)
from .lake import batch_exists, drop_batch, lake_load, stage_to_lake
from .tables import (
    STAGING_HOURS,
    STAGING_TEMPLATE,
    KeyMatch,
    LandingTable,
    cluster_layout,
    expire_partitions,
    expire_staging,
    folder_values,
    staging_name,
)

_ASIDE, _OWN = "__aside", "__own"
_STRAYS = "__stray"  # where a log that is split by stream keeps the lines of none
_QUARANTINE = threading.Lock()

# Setting and method names of other loaders' configurations, and what they are here.
METHODS = {
    "batch_job": "batch_job",
    "lake_stage": "lake_stage",
    "gcs_stage": "lake_stage",
    "storage_write_api": "batch_job",
    "streaming_insert": "batch_job",
}
RENAMED_SETTINGS = {"dataset": "database", "bucket": "lake_root"}
IGNORED_SETTINGS = {"timeout", "options"}  # a user may count on these: they are told
UNUSED_SETTINGS = {"project", "location", "credentials_path", "credentials_json", *IGNORED_SETTINGS}


class LoadError(RuntimeError):
    """A load was stopped before it became visible; the bookmark has not moved."""


@dataclass(frozen=True)
class LoadConfig:
    """Settings of a load.

    ``of`` accepts a plain mapping with these names, and the configuration of a
    loader that ran outside Spark: settings about its workers and credentials
    have no meaning here and are passed over.
    """

    database: str = "default"
    denormalized: bool = False
    method: str = "batch_job"  # or "lake_stage"
    upsert: Any = False
    overwrite: Any = False
    dedupe_before_upsert: Any = False
    only_if_newer: bool = False
    fail_fast: bool = True
    generate_view: bool = False
    strict_view: bool = True
    timestamp_format: str | None = None
    column_name_transforms: Mapping[str, bool] = field(default_factory=dict)
    schema_resolver_version: int = 1
    partition_granularity: str = "month"
    partition_expiration_days: int | None = None
    cluster_on_key_properties: bool = False
    clustering_fields: tuple[str, ...] = ()
    stream_maps: Mapping[str, Any] = field(default_factory=dict)
    stream_map_config: Mapping[str, Any] = field(default_factory=dict)
    flattening_enabled: bool = False
    flattening_max_depth: int = 0
    lake_root: str | None = None
    staging_root: str | None = None
    state_path: str | None = None
    temporary_table_expiration_hours: int = STAGING_HOURS
    temporary_table_name_template: str = STAGING_TEMPLATE
    concurrent_streams: int = 4  # tables loaded at a time, so that small ones do not idle a cluster
    batch_size: int | None = None  # most rows of a written file
    batch_bytes: int | None = None  # most bytes of log that a micro-batch takes in
    load_again: bool = False  # load a log although its tables have it

    @classmethod
    def of(cls, settings: LoadConfig | Mapping[str, Any]) -> LoadConfig:
        if isinstance(settings, LoadConfig):
            return settings
        known = {f.name for f in fields(cls)}
        idle = sorted(k for k in settings if k in IGNORED_SETTINGS and settings[k] is not None)
        if idle:
            warnings.warn(f"settings without effect here: {', '.join(idle)}", stacklevel=2)
        chosen = {RENAMED_SETTINGS.get(k, k): v for k, v in settings.items() if k not in UNUSED_SETTINGS}
        unknown = sorted(set(chosen) - known)
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(unknown)}")
        return cls(**{k: v for k, v in chosen.items() if v is not None})

    def __post_init__(self) -> None:
        if self.method not in METHODS:
            raise ValueError(f"Unknown method: {self.method}")
        object.__setattr__(self, "method", METHODS[self.method])

    @property
    def rules(self) -> NameRules:
        return NameRules.of(self.column_name_transforms)

    @property
    def shape(self) -> str:
        return "denormalized" if self.denormalized else "fixed"

    def staging_folder(self, spark: SparkSession) -> str:
        return self.staging_root or f"{scratch_root(spark)}/sluiceway-staging"


@dataclass(frozen=True)
class LoadResult:
    stream: str
    table: str
    mode: str
    load_id: int
    rows: int
    rejected: int


def resolve_mode(spec: StreamSpec, config: LoadConfig) -> str:
    """``upsert`` needs keys and typed columns, and goes before ``overwrite``; else ``append``."""
    if is_selected(config.upsert, spec.name):
        if spec.key_properties and config.denormalized:
            return "upsert"
        warnings.warn(f"{spec.name}: upsert needs key properties and denormalized=true, ignored", stacklevel=2)
    return "overwrite" if is_selected(config.overwrite, spec.name) else "append"


def clustering(spec: StreamSpec, config: LoadConfig) -> tuple[str, ...]:
    """Columns a load is sorted by. Explicit fields go before keys.

    The default, the batch time, is one value per load and needs no sort.
    """
    if config.clustering_fields:
        return tuple(config.clustering_fields)
    if spec.key_properties and config.cluster_on_key_properties and config.denormalized:
        return tuple(key_names(spec.key_properties, config.rules))
    return ()


def table_comment(spec: StreamSpec, config: LoadConfig) -> str:
    """Table description: the stream's schema and the table shape."""
    text = json.dumps(spec.json_schema)
    return f"Loaded from a message stream.\nStream schema\n{text}\nShape: {config.shape}"


def mapped_spec(spec: StreamSpec, config: LoadConfig) -> StreamSpec:
    """Name and keys of a stream after its map."""
    settings = config.stream_maps.get(spec.name) or {}
    keys = settings.get(KEYS, spec.key_properties) or ()
    return replace(spec, name=settings.get(ALIAS, spec.name), key_properties=tuple(keys))


def stream_rows(
    msgs: DataFrame,
    spec: StreamSpec,
    config: LoadConfig,
    as_of: dt.datetime,
    prefilter: bool = True,
    known: Sequence[str] | None = None,
    files: Mapping[str, list[str]] | None = None,
) -> tuple[DataFrame, T.StructType]:
    """Table rows of a stream with hidden columns beside them, and the table's schema.

    With the ``known`` streams of the log its other lines stay, under their outcome. ``files`` are batch files by format.
    """
    resolver, settings = config.schema_resolver_version, config.stream_maps.get(spec.name) or {}
    typed_files = bool(settings) or config.flattening_enabled or config.denormalized
    more = batch_records(msgs.sparkSession, files, spec, resolver if typed_files else None) if files else None
    if settings or config.flattening_enabled:
        typed = project_denormalized(msgs, spec, None, resolver, as_of, True, prefilter, known, more)
        rows = _reshaped(typed, settings, config)
        return rows, T.StructType([f for f in rows.schema.fields if f.name not in HIDDEN])
    schema = resolve_schema(spec, config.shape, resolver, config.rules)
    if config.denormalized:
        return project_denormalized(msgs, spec, config.rules, resolver, as_of, True, prefilter, known, more), schema
    return project_fixed(msgs, spec, as_of, True, prefilter, known, more), schema


def _reshaped(typed: DataFrame, settings: Mapping[str, Any], config: LoadConfig) -> DataFrame:
    """Apply a stream map, flattening and the name rules to the record's own columns.

    Metadata and hidden columns ride along in an array, which none of the three
    looks into.
    """
    aside = [c for c in typed.columns if c in HIDDEN or c in METADATA_COLUMNS]
    df = typed.withColumn(_ASIDE, F.array(F.struct(*aside))).drop(*aside)
    if settings:
        if settings.get(FILTER):  # the user's filter is about rows that can be loaded
            settings = {**settings, FILTER: f"({settings[FILTER]}) OR {_ASIDE}[0].{OUTCOME} <> '{GOOD}'"}
        df = apply_stream_map(df, {**settings, _ASIDE: _ASIDE}, config.stream_map_config)
    if config.flattening_enabled:
        df = flatten(df, config.flattening_max_depth)
    record = [f for f in df.schema.fields if f.name != _ASIDE]
    columns: list[Column] = [F.col(quoted(f.name)) for f in record]
    if config.denormalized:
        target = rename_struct(T.StructType(record), config.rules)
        columns = [c.cast(f.dataType).alias(f.name) for c, f in zip(columns, target.fields)]
    else:
        columns = [json_value(F.struct(*columns)).alias("data")]
    named = df.select(*columns, F.col(_ASIDE)[0].alias(_ASIDE))
    return named.select(*[quoted(c) for c in named.columns if c != _ASIDE], f"{_ASIDE}.*")


def _wall_clock() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _staging_path(spark: SparkSession, config: LoadConfig, table: str) -> str:
    """A new staging folder. It is named, and later expired, by the wall clock, whatever date a load is for."""
    return f"{config.staging_folder(spark)}/{staging_name(table, _wall_clock(), config.temporary_table_name_template)}"


def _quarantine(spark: SparkSession, rows: DataFrame, stream: str, config: LoadConfig, load: str) -> None:
    """Keep rejected ``(raw, reason)`` rows by stream and load. A retry replaces its own rows."""
    name = quoted_table(f"{config.database}.quarantine")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (raw STRING, reason STRING, stream STRING, load STRING)"
        " USING parquet PARTITIONED BY (stream, load)"
    )
    out = rows.select("raw", "reason", F.lit(stream).alias("stream"), F.lit(load).alias("load"))
    own = f"PARTITION (stream={sql_text(stream)}, load={sql_text(load)})"
    with _QUARANTINE:  # two jobs cannot commit to one folder at a time
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {own}")
        out.write.insertInto(f"{config.database}.quarantine")


def stray_lines(lines: DataFrame, known: list[str]) -> DataFrame:
    """Lines that are no message, or records of a stream without a schema: ``(raw, reason)``."""
    heads = lines.filter(F.trim("payload") != "").select("payload", parsed_once(F.col("payload"), HEAD))
    return heads.select(F.col("payload").alias("raw"), stray_reason(known).alias("reason")).filter(
        "reason IS NOT NULL"
    )


@dataclass
class _StreamLoad:
    """One stream on its way into its table.

    The log is parsed once: one job writes good rows, rejected ones, lines of no stream and bookmarks to folders of
    their own. What is counted is what was written, so a task that ran twice counts once.
    """

    spark: SparkSession
    spec: StreamSpec
    config: LoadConfig
    as_of: dt.datetime
    rows: DataFrame
    schema: T.StructType
    facts: Mapping[str, str] = field(default_factory=dict)
    follows_batches: bool = True  # files that BATCH lines name are among the rows
    state: str | None = None  # the last bookmark among the lines
    strays: int = 0

    def __post_init__(self) -> None:
        self.mapped = mapped_spec(self.spec, self.config)
        self.table_id = table_name_of(self.mapped.name)
        self.name = f"{self.config.database}.{self.table_id}"
        self.mode = resolve_mode(self.mapped, self.config)
        self.keys = key_names(self.mapped.key_properties, self.config.rules)
        self.key = "-".join([self.table_id, str(int(self.as_of.timestamp() * 1000)), *filter(None, [self.facts.get("batch")])])
        self.staged: list[str] = []
        self.lake_folder: str | None = None

    @property
    def dedupes(self) -> bool:
        return self.mode == "upsert" and is_selected(self.config.dedupe_before_upsert, self.spec.name)

    def route(self) -> tuple[DataFrame, tuple[int, int]]:
        """Good rows, staged and judged, and the counts of good and rejected ones."""
        rows = self.rows
        if self.dedupes:  # a line that is not loaded is alone under its key
            latest = ("_sdc_extracted_at", "_sdc_received_at", "_sdc_sequence", SEQ)
            alone = rows.withColumn(_OWN, F.when(F.col(OUTCOME) != GOOD, F.col(SEQ)))
            rows = dedupe_latest(alone, [*self.keys, _OWN], [c for c in latest if c in rows.columns]).drop(_OWN)
        beside = [F.when(F.col(OUTCOME) != GOOD, F.col(c)).alias(c) for c in (SEQ, PAYLOAD)]
        out = rows.select(*[F.col(quoted(c)) for c in rows.columns if c not in (SEQ, PAYLOAD, OUTCOME)], *beside, OUTCOME)
        path = _staging_path(self.spark, self.config, self.table_id)
        self.staged.append(path)
        out.write.partitionBy(OUTCOME).parquet(path)
        written = self.spark.read.schema(out.schema).parquet(path)
        counts = {r[OUTCOME]: r["count"] for r in written.groupBy(OUTCOME).count().collect()}  # from file footers
        self.judge(written, counts)
        good = written.filter(F.col(OUTCOME) == GOOD).drop(*HIDDEN)
        return good, (counts.get(GOOD, 0), counts.get(REJECTED, 0))

    def judge(self, written: DataFrame, counts: Mapping[str, int]) -> None:
        """Before anything shows: decide on the lines that cannot be loaded."""
        fail_fast = self.config.fail_fast
        if counts.get(BATCH) and not self.follows_batches:
            raise LoadError("the log names batch files; load it without giving its streams")
        self.strays = counts.get(STRAY, 0)
        if self.strays and fail_fast:
            raise LoadError(f"{self.strays} lines are no message, or records of a stream without a schema")
        rejected = counts.get(REJECTED, 0)
        if rejected and fail_fast:
            raise LoadError(f"{self.spec.name}: {rejected} of {counts.get(GOOD, 0) + rejected} records were rejected")
        set_aside = {REJECTED: (self.spec.name, self.key), STRAY: ("unassigned", f"log-{int(self.as_of.timestamp() * 1000)}")}
        for outcome, (stream, load) in set_aside.items():
            if counts.get(outcome):
                bad = written.filter(F.col(OUTCOME) == outcome)
                _quarantine(self.spark, bad.select(F.col(PAYLOAD).alias("raw"), F.col(REJECT).alias("reason")), stream, self.config, load)
        if counts.get(STATE):
            bookmarks = written.filter(F.col(OUTCOME) == STATE)
            self.state = bookmarks.agg(F.max_by(REJECT, SEQ).alias("state")).first()["state"]

    def without_conflicts(self, match: KeyMatch, source: DataFrame) -> DataFrame:
        """The source, once the rows are set aside that would update one row together."""
        clash = match.conflicts().select(*[quoted(k) for k in match.keys])
        if clash.isEmpty():
            return source
        if self.config.fail_fast:
            raise LoadError(f"{self.spec.name}: several records update one row; set dedupe_before_upsert")
        doubled = source.join(clash, list(match.keys), "left_semi")
        as_text = F.to_json(F.struct(*[quoted(c) for c in source.columns])).alias("raw")
        reason = F.lit("several records update one row").alias("reason")
        _quarantine(self.spark, doubled.select(as_text, reason), self.spec.name, self.config, f"{self.key}-conflicts")
        kept = source.join(clash, list(match.keys), "left_anti").select(*[quoted(c) for c in source.columns])
        path = _staging_path(self.spark, self.config, self.table_id)
        self.staged.append(path)
        kept.write.parquet(path)
        return self.spark.read.schema(kept.schema).parquet(path)

    def run(self) -> LoadResult:
        self.write()
        return self.show()

    def through_lake(self, rows: DataFrame) -> DataFrame:
        """Good rows staged as a batch of the lake, read back from there."""
        spark, config = self.spark, self.config
        root = config.lake_root or f"{scratch_root(spark)}/sluiceway-lake"
        folder = lake_folder(root, self.mapped.name, config.database)
        if batch_exists(spark, folder, self.key):
            raise FileExistsError(f"batch {self.key} is already staged under {folder}")
        self.lake_folder = folder
        stage_to_lake(rows, root, self.mapped.name, self.key, self.as_of, config.database, config.batch_size)
        return lake_load(spark, root, self.mapped.name, self.schema, [self.key], dataset=config.database)

    def write(self) -> None:
        """Stage the rows, judge them, and prepare what ``show`` does. No table is touched but for new columns."""
        spark, config = self.spark, self.config
        comment = table_comment(self.spec, config)
        table = LandingTable.create(spark, self.name, self.schema, config.partition_granularity, comment).begin(spark)
        if "log" in self.facts and table.facts.get("log") == self.facts["log"] and not config.load_again:
            self.written = (table, self.schema, comment, "loaded before", None, (0, 0))
            return
        same_query = "query" in self.facts and table.facts.get("query") == self.facts["query"]
        mode = "append" if self.mode == "overwrite" and same_query else self.mode  # a stream replaces a table once
        rows, judged = self.route()
        if config.method == "lake_stage":
            rows = self.through_lake(rows)
        schema = self.schema if mode == "overwrite" else table.evolve(spark, self.schema)
        known = {k: v for k, v in table.facts.items() if k != "log"}
        table = replace(table, facts={**known, **self.facts})
        if mode == "upsert":
            match = table.match(spark, rows, self.keys)
            source = rows if self.dedupes else self.without_conflicts(match, rows)
            table = table.merge(spark, source, self.keys, config.only_if_newer, match)
        self.written = (table, schema, comment, mode, rows, judged)

    def show(self) -> LoadResult:
        """Write what is staged into the table, and publish it."""
        spark, config = self.spark, self.config
        table, schema, comment, mode, rows, judged = self.written
        if mode in ("append", "overwrite"):
            layout = clustering(self.mapped, config)
            rows = cluster_layout(rows, layout) if layout else rows
            table = table.append(spark, rows) if mode == "append" else table.overwrite(spark, rows, schema, comment)
        if mode != "loaded before":
            table = table.publish(spark, schema, comment)
        self.lake_folder = None
        self.clear()
        if config.partition_expiration_days is not None:
            expire_partitions(spark, self.name, config.partition_expiration_days, self.as_of)
        if config.generate_view and not config.denormalized:
            struct = to_struct(self.spec.json_schema, config.schema_resolver_version)
            create_view(spark, self.name, struct, config.rules, config.timestamp_format, config.strict_view)
        return LoadResult(self.spec.name, self.name, mode, table.load_id, *judged)

    def clear(self) -> None:
        """Remove what was staged. A batch that no table has taken in leaves the lake, so that it can be staged again."""
        for path in self.staged:
            remove_folder(self.spark, path)
        if self.lake_folder:
            drop_batch(self.spark, self.lake_folder, self.key)


def create_view(
    spark: SparkSession,
    table: str,
    struct: T.StructType,
    rules: NameRules | Mapping[str, bool] | None = None,
    ts_format: str | None = None,
    strict: bool = True,
) -> str:
    """Store the typed view ``<table>_view`` over a fixed table."""
    spark.sql(view_statement(f"{table}_view", table, view_columns(struct, rules, ts_format, strict)))
    return f"{table}_view"


def load(
    df: DataFrame,
    table: str,
    mode: str = "append",
    keys: Sequence[str] | None = None,
    partition: str = "month",
    cluster: Sequence[str] | None = None,
    only_if_newer: bool = False,
    comment: str = "",
) -> LandingTable:
    """Load any frame into a table, created if missing, and publish it.

    The frame is read more than once by an upsert and by clustering, so it
    should come from files. ``_sdc_batched_at``, if there, decides the partition.
    """
    if mode not in ("append", "overwrite", "upsert"):
        raise ValueError(f"Unknown write mode: {mode}")
    spark, schema = df.sparkSession, df.schema
    landing = LandingTable.create(spark, table, schema, partition, comment).begin(spark)
    rows = cluster_layout(df, cluster) if cluster else df
    if mode == "overwrite":
        landing = landing.overwrite(spark, rows, schema, comment)
    else:
        schema = landing.evolve(spark, schema)
        landing = landing.append(spark, rows, gather=not cluster) if mode == "append" else landing.merge(spark, rows, keys or (), only_if_newer)
    return landing.publish(spark, schema, comment or None)


def load_stream(
    spark: SparkSession,
    msgs: DataFrame,
    spec: StreamSpec,
    config: LoadConfig | Mapping[str, Any],
    as_of: dt.datetime,
    facts: Mapping[str, str] | None = None,
    prefilter: bool = True,
) -> LoadResult:
    """Load one stream of a message frame and publish its table; nothing shows until the rejected rows have been judged."""
    config = LoadConfig.of(config)
    with files_of(spark, config.batch_size):
        return _run_all({spec.name: _loading(spark, with_order(msgs), spec, config, as_of, facts, prefilter)}, 1)[spec.name]


def _loading(spark, msgs, spec, config, as_of, facts=None, prefilter=True, known=None, files=None, follows=True) -> _StreamLoad:
    rows, schema = stream_rows(msgs, spec, config, as_of, prefilter, known, files)
    return _StreamLoad(spark, spec, config, as_of, rows, schema, facts or {}, follows)


def _has_table(spark: SparkSession, spec: StreamSpec, config: LoadConfig) -> bool:
    return spark.catalog.tableExists(f"{config.database}.{table_name_of(mapped_spec(spec, config).name)}")


def split_streams(spark: SparkSession, lines: DataFrame, config: LoadConfig, known: Sequence[str]) -> tuple[DataFrame, str]:
    """Parse the envelope once and write one folder per stream, for logs of several streams; one more holds lines of no stream.

    Rows are rebalanced by stream before the write, so files do not grow with tasks times streams;
    adaptive execution splits a stream that is a third of the log over many tasks.
    """
    path = _staging_path(spark, config, "messages")
    msgs = as_messages(lines).filter(F.trim("payload") != "").withColumn("reason", stray_reason(known))
    stream = F.when(F.col("reason").isNotNull(), F.lit(_STRAYS)).when(F.col("type") == "RECORD", F.col("stream"))
    records = msgs.withColumn("stream", stream).filter(F.col("stream").isNotNull()).drop("type")
    records.hint("rebalance", "stream").write.partitionBy("stream").parquet(path)
    return spark.read.schema(records.schema).parquet(path), path


def _run_all(loads: Mapping[str, _StreamLoad], at_a_time: int) -> dict[str, LoadResult]:
    """Stage and judge every stream, then show them all: one that fails leaves no table moved, and nothing in the lake.

    Streams that share a table take turns in between, as each builds on what the one before has shown.
    """
    shared: dict[str, list[str]] = {}
    for name, one in loads.items():
        shared.setdefault(one.name, []).append(name)
    alone = [names[0] for names in shared.values() if len(names) == 1]
    turns = [names for names in shared.values() if len(names) > 1]
    try:
        with ThreadPoolExecutor(max(1, at_a_time)) as pool:
            list(pool.map(lambda n: loads[n].write(), alone))
            done = dict(pair for pairs in pool.map(lambda names: [(n, loads[n].run()) for n in names], turns) for pair in pairs)
            done.update(zip(alone, pool.map(lambda n: loads[n].show(), alone)))
    except BaseException:
        for one in loads.values():
            one.clear()
        raise
    return done


def load_messages(
    spark: SparkSession,
    source: str | list[str] | DataFrame,
    config: LoadConfig | Mapping[str, Any],
    as_of: dt.datetime,
    specs: Mapping[str, StreamSpec] | None = None,
    facts: Mapping[str, str] | None = None,
    found: LogFacts | None = None,
) -> tuple[list[LoadResult], str | None]:
    """Load every stream of a log. Returns the results and the bookmark.

    All streams are staged and judged before any table is published, and the bookmark is
    returned (and written, with ``state_path``) only after every table is. Files named by BATCH messages are part of the log.
    Records without a schema, and lines that are no message, stop the load under
    ``fail_fast`` and are set aside otherwise. A map of ``None`` leaves a stream out.

    A table remembers the files it was last loaded from. A load that died between its tables and its bookmark can be
    repeated: tables that have the log are left as they are. ``load_again`` loads it nevertheless.

    With the streams given as ``specs`` a log of one stream is read once: the
    bookmark is picked up by the pass that parses it. ``found`` takes facts the
    caller has looked up already.
    """
    prepare_session(spark)
    config = LoadConfig.of(config)
    facts = dict(facts or {})
    if isinstance(source, DataFrame):
        lines = with_order(source)
    else:
        lines = read_lines(spark, source)
        facts.setdefault("log", log_identity(spark, source))
    lines = lines.filter(F.trim("payload") != "")
    if specs is None and found is None:
        found = log_facts(lines)
    specs = found.specs if specs is None else specs
    chosen = {n: s for n, s in specs.items() if config.stream_maps.get(n, {}) is not None}
    split = len(chosen) > 1  # a log of one stream has nothing to split
    if found is None and (split or not chosen):
        found = log_facts(lines)
    files = batch_files(lines) if found and found.batches else {}
    known = list(specs)
    folder, set_aside = None, 0
    if split:
        msgs, folder = split_streams(spark, lines, config, known)
        strays = msgs.filter(F.col("stream") == _STRAYS)
        set_aside = strays.count() if _STRAYS in folder_values(spark, folder, "stream") else 0
        if set_aside and config.fail_fast:
            remove_folder(spark, folder)
            raise LoadError(f"{set_aside} lines are no message, or records of a stream without a schema")
        if "batch" in facts:  # a micro-batch leaves the tables of idle streams alone
            there = folder_values(spark, folder, "stream") | set(files)
            chosen = {n: s for n, s in chosen.items() if n in there or not _has_table(spark, s, config)}
    elif not chosen:
        strays = stray_lines(lines, known)
        if config.fail_fast and not strays.isEmpty():
            raise LoadError("the log declares no stream to load, but holds other lines")
        set_aside = 0 if config.fail_fast else strays.count()
    if split:
        loads = {
            n: _loading(spark, msgs.filter(F.col("stream") == n).drop("stream", "reason"), s, config, as_of, facts, False, None, files.get(n))
            for n, s in chosen.items()
        }
    else:  # the one stream's pass also looks after the other lines
        loads = {n: _loading(spark, lines, s, config, as_of, facts, False, known, files.get(n), found is not None) for n, s in chosen.items()}
    with files_of(spark, config.batch_size):
        done = _run_all(loads, config.concurrent_streams)
    results = [done[n] for n in chosen]
    if set_aside:
        raw = strays.select(F.col("payload").alias("raw"), "reason") if split else strays
        _quarantine(spark, raw, "unassigned", config, f"log-{int(as_of.timestamp() * 1000)}")
    if folder:
        remove_folder(spark, folder)
    bookmark = found.state if found else next((one.state for one in loads.values() if one.state), None)
    expire_staging(spark, config.staging_folder(spark), _wall_clock(), config.temporary_table_expiration_hours)
    if bookmark and config.state_path:
        stamp = int(as_of.timestamp() * 1000)
        spark.createDataFrame([(bookmark,)], "state STRING").coalesce(1).write.mode("overwrite").parquet(
            f"{config.state_path}/load={stamp}"
        )
    return results, bookmark


def read_state(spark: SparkSession, path: str) -> str | None:
    """The bookmark of the newest finished load."""
    newest = spark.read.parquet(path).orderBy(F.col("load").desc()).limit(1).collect()
    return newest[0].state if newest else None
