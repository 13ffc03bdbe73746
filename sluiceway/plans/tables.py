"""Tables of plain Parquet in the session catalog, partitioned by batch period.

The public name is a view. Behind it lies an ordinary partitioned Parquet table,
with the id of the load that brought a row in one more column::

    orders      VIEW   SELECT … FROM orders__v1 WHERE _load_id <= 7
    orders__v1  TABLE  PARTITIONED BY (_sdc_batched_month)

An append is an ``INSERT INTO``; its rows show when the view is replaced, one
catalog update that moves data, bookmark and batch id together. An overwrite
writes a new table and repoints the view. An upsert rewrites the partitions it
touches with dynamic partition overwrite.

A load notes in the view what it is about to do. If it dies, the next one first
takes out the rows of a broken append, or finishes a broken upsert from its
staged rows, which can be written any number of times.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.evolve import column_ddl, conform, evolve_table, merged_struct
from ..operators.merge import conflicting, key_matches, key_range, merge_columns, shared_rows, upsert
from ..session import prepare_session, quoted, quoted_table, remove_folder, scratch_path, sql_text

LOAD_ID = "_load_id"
GRAINS = ("hour", "day", "month", "year")
_PROPERTY = "sluiceway."
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
_SPECS = 500  # partitions of one DROP statement

# How staging folders are named, and how long they live.
STAGING_TEMPLATE = "{table_name}__{timestamp}__{uuid}"
STAGING_HOURS = 168


def partition_column(grain: str) -> str:
    """Name of the partition column for a grain."""
    if grain not in GRAINS:
        raise ValueError(f"partition granularity must be one of {', '.join(GRAINS)}, not {grain!r}")
    return f"_sdc_batched_{grain}"


def partition_value(grain: str, at: Column | str = "_sdc_batched_at") -> Column:
    """Start of the hour, day, month or year: a date, or a timestamp for hours."""
    partition_column(grain)
    start = F.date_trunc(grain, F.col(at) if isinstance(at, str) else at)
    return start if grain == "hour" else start.cast("date")


def cluster_layout(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Sort the rows into files that cover narrow ranges, so readers skip by min and max.

    A row number salts the range, so one value that holds a third of the rows is
    split over many files instead of filling one task.
    """
    salt = "__salt"
    by = [*[F.col(quoted(c)) for c in columns], F.col(salt)]
    salted = df.withColumn(salt, F.monotonically_increasing_id())
    ranged = salted.repartitionByRange(partitions, *by) if partitions else salted.repartitionByRange(*by)
    return ranged.sortWithinPartitions(*[quoted(c) for c in columns]).drop(salt)


def staging_name(table: str, at: dt.datetime, template: str = STAGING_TEMPLATE, token: str | None = None) -> str:
    """Folder name of staged rows; whatever is not a letter, digit or underscore becomes one."""
    text = template.format(
        table_name=table, timestamp=at.strftime("%Y%m%d%H%M%S"), uuid=token or uuid.uuid4().hex
    )
    return re.sub(r"[^a-zA-Z0-9_]", "_", text)


def staged_at(name: str) -> dt.datetime | None:
    """When a staging folder was made, read from its name."""
    found = re.search(r"(?<!\d)(\d{14})(?!\d)", name)
    try:
        return dt.datetime.strptime(found[1], "%Y%m%d%H%M%S").replace(tzinfo=dt.timezone.utc) if found else None
    except ValueError:
        return None


def folder_values(spark: SparkSession, path: str, column: str) -> set[str]:
    """Values of a partition column below a folder, from folder names alone."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)]
    return {_unescape(n.removeprefix(f"{column}=")) for n in names if n.startswith(f"{column}=")}


def expire_staging(spark: SparkSession, root: str, as_of: dt.datetime, hours: int = STAGING_HOURS) -> list[str]:
    """Delete staging folders older than ``hours``. Only folder names are read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    gone = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        made = staged_at(name)
        if status.isDirectory() and made and made < as_of - dt.timedelta(hours=hours):
            fs.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


@dataclass(frozen=True)
class Merge:
    """An upsert that is staged: its rows, and the values of the partitions to replace and of all that it writes."""

    path: str
    replaced: tuple[str, ...]
    written: tuple[str, ...]


@dataclass(frozen=True)
class KeyMatch:
    """Which rows of a table have a key of a source, staged: keys, ``source_rows`` and the partition."""

    frame: DataFrame
    path: str
    keys: tuple[str, ...]

    def conflicts(self) -> DataFrame:
        """Keys that several source rows would update."""
        return conflicting(self.frame, self.keys)


@dataclass(frozen=True)
class LandingTable:
    """What the catalog knows about a published table."""

    name: str
    physical: str
    grain: str
    load_id: int = 0
    retired: str | None = None
    pending: str = ""  # what a load that has not finished was doing
    merge_of: Merge | None = None  # applied when published
    facts: Mapping[str, str] = field(default_factory=dict)

    # ---- catalog ----------------------------------------------------------

    @classmethod
    def find(cls, spark: SparkSession, name: str) -> LandingTable | None:
        """Read a table's state from its view, or None if there is no such table."""
        if not spark.catalog.tableExists(name):
            return None
        rows = spark.sql(f"SHOW TBLPROPERTIES {quoted_table(name)}").collect()
        known = {r.key.removeprefix(_PROPERTY): r.value for r in rows if r.key.startswith(_PROPERTY)}
        if "physical" not in known:
            raise ValueError(f"{name} exists but was not created by a load")
        return cls(
            name,
            known.pop("physical"),
            known.pop("grain"),
            int(known.pop("load_id")),
            known.pop("retired") or None,
            known.pop("pending", ""),
            None,
            known,
        )

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        name: str,
        schema: T.StructType,
        grain: str = "month",
        comment: str = "",
    ) -> LandingTable:
        """The table of this name, made empty if it does not exist yet."""
        found = cls.find(spark, name)
        if found:
            return found
        table = cls(name, f"{name}__v1", grain)
        table._make(spark, schema, comment)
        table.publish(spark, schema=schema, comment=comment)
        return table

    def _make(self, spark: SparkSession, schema: T.StructType, comment: str) -> None:
        part = T.StructField(self.part, T.TimestampType() if self.grain == "hour" else T.DateType())
        columns = [*schema.fields, T.StructField(LOAD_ID, T.LongType()), part]
        ddl = ", ".join(column_ddl(f) for f in columns)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {quoted_table(self.physical)} ({ddl}) USING parquet"
            f" PARTITIONED BY ({self.part}) COMMENT {sql_text(comment)}"
        )

    @property
    def part(self) -> str:
        return partition_column(self.grain)

    def schema(self, spark: SparkSession) -> T.StructType:
        """Columns of the public table."""
        return spark.table(self.name).schema

    def evolve(self, spark: SparkSession, incoming: T.StructType) -> T.StructType:
        """Append missing columns and nested fields; the view shows them from the next publish on."""
        evolve_table(spark, self.physical, incoming)
        return merged_struct(self.schema(spark), incoming)

    def begin(self, spark: SparkSession) -> LandingTable:
        """Clear up after the last load. One writer per table at a time."""
        prepare_session(spark)
        table = self
        if self.pending:
            table = self._recover(spark)
        if table.retired:
            spark.sql(f"DROP TABLE IF EXISTS {quoted_table(table.retired)}")
        return replace(table, retired=None)

    def _recover(self, spark: SparkSession) -> LandingTable:
        """Finish an upsert whose rows are staged; take the rows of any other dead load out again."""
        noted = json.loads(self.pending)
        if "path" not in noted:
            self._take_out(spark, None)
            return replace(self, pending="")
        merge = Merge(noted["path"], tuple(noted["replaced"]), tuple(noted["written"]))
        self._take_out(spark, [v for v in merge.written if v not in merge.replaced])
        done = replace(self, load_id=self.load_id + 1, merge_of=merge, pending="", facts={**self.facts, **noted["facts"]})
        done.publish(spark)
        return replace(done, merge_of=None)

    def _take_out(self, spark: SparkSession, values: Sequence[str] | None) -> None:
        """Rewrite partitions (all, or those of the given values) without the rows of a load that was never published."""
        every = spark.table(self.physical)
        mine = every if values is None else every.filter(self._in(values))
        dead = [r[0] for r in mine.filter(F.col(LOAD_ID) > self.load_id).select(self._text()).distinct().collect()]
        if dead:
            kept = every.filter(self._in(dead) & (F.col(LOAD_ID) <= self.load_id))
            left = [r[0] for r in kept.select(self._text()).distinct().collect()]
            kept.write.insertInto(self.physical, overwrite=True)
            self.drop_partitions(spark, [v for v in dead if v not in left])

    def _note(self, spark: SparkSession, what: Mapping[str, object]) -> None:
        """Write into the view what is about to happen, before anything does."""
        text = sql_text(json.dumps(what))
        spark.sql(f"ALTER VIEW {quoted_table(self.name)} SET TBLPROPERTIES ({sql_text(_PROPERTY + 'pending')} = {text})")

    def partitions(self, spark: SparkSession) -> list[str]:
        """Values of the partitions, from the catalog alone."""
        rows = spark.sql(f"SHOW PARTITIONS {quoted_table(self.physical)}").collect()
        return [_unescape(r.partition.removeprefix(f"{self.part}=")) for r in rows]

    def drop_partitions(self, spark: SparkSession, values: Sequence[str]) -> None:
        """Drop partitions, many to a statement."""
        for i in range(0, len(values), _SPECS):
            specs = ", ".join(f"PARTITION ({self.part}={self._value(v)})" for v in values[i : i + _SPECS])
            spark.sql(f"ALTER TABLE {quoted_table(self.physical)} DROP IF EXISTS {specs}")

    def _value(self, value: str) -> str:
        kind = "TIMESTAMP" if self.grain == "hour" else "DATE"
        return "NULL" if value == _NO_VALUE else f"{kind} {sql_text(value)}"

    def _text(self) -> Column:
        return F.coalesce(F.col(self.part).cast("string"), F.lit(_NO_VALUE))

    def _in(self, values: Sequence[str]) -> Column:
        """A test on the partition column alone, so that other partitions are not opened."""
        named = [self._value(v) for v in values if v != _NO_VALUE]
        tests = [f"{self.part} IN ({', '.join(named)})"] if named else []
        tests += [f"{self.part} IS NULL"] if _NO_VALUE in values else []
        return F.expr(f"coalesce({' OR '.join(tests) or 'false'}, false)")

    def publish(
        self, spark: SparkSession, schema: T.StructType | None = None, comment: str | None = None
    ) -> LandingTable:
        """Make the current state public, in one catalog update; an upsert replaces its partitions first."""
        if self.merge_of:
            self._apply(spark, self.merge_of)
        schema = schema or self.schema(spark)
        if comment is None:
            comment = self.facts.get("comment", "")
        facts = {
            **self.facts,
            "comment": comment,
            "physical": self.physical,
            "grain": self.grain,
            "load_id": str(self.load_id),
            "retired": self.retired or "",
            "pending": "",
        }
        properties = ", ".join(f"{sql_text(_PROPERTY + k)} = {sql_text(v)}" for k, v in facts.items())
        heads = ", ".join(
            quoted(f.name) + (f" COMMENT {sql_text(f.metadata['comment'])}" if "comment" in f.metadata else "")
            for f in schema.fields
        )
        columns = ", ".join(quoted(f.name) for f in schema.fields)
        spark.sql(
            f"CREATE OR REPLACE VIEW {quoted_table(self.name)} ({heads}) COMMENT {sql_text(comment)}"
            f" TBLPROPERTIES ({properties}) WITH SCHEMA TYPE EVOLUTION"  # a struct may grow before the next publish
            f" AS SELECT {columns} FROM {quoted_table(self.physical)} WHERE {LOAD_ID} <= {self.load_id}"
        )
        if self.merge_of:
            remove_folder(spark, self.merge_of.path)
        return replace(self, merge_of=None, pending="")

    # ---- data -------------------------------------------------------------

    def rows(self, spark: SparkSession) -> DataFrame:
        """Published rows with load id and partition."""
        return spark.table(self.physical).filter(F.col(LOAD_ID) <= self.load_id)

    def _laid_out(self, spark: SparkSession, df: DataFrame, load_id: Column) -> DataFrame:
        """Rows in the columns of the physical table, in their order."""
        have = {f.name.lower(): f.dataType for f in df.schema.fields}
        at = F.col("_sdc_batched_at") if "_sdc_batched_at" in have else F.lit(None).cast("timestamp")

        def column(f: T.StructField) -> Column:
            if f.name in (LOAD_ID, self.part):
                return load_id if f.name == LOAD_ID else partition_value(self.grain, at)
            there = f.name.lower() in have
            return conform(F.col(quoted(f.name)), have[f.name.lower()], f.dataType) if there else F.lit(None).cast(f.dataType)

        return df.select(*[column(f).alias(f.name) for f in spark.table(self.physical).schema.fields])

    def append(self, spark: SparkSession, df: DataFrame, gather: bool = False) -> LandingTable:
        """Insert ``df`` as the next load, ready to publish.

        ``gather`` brings the rows of a partition together first, in pieces of even size, where
        every task holds rows of every partition.
        """
        out = self._laid_out(spark, df, F.lit(self.load_id + 1))
        self._note(spark, {"load": self.load_id + 1})
        (out.hint("rebalance", self.part) if gather else out).write.insertInto(self.physical)
        return replace(self, load_id=self.load_id + 1)

    def overwrite(self, spark: SparkSession, df: DataFrame, schema: T.StructType, comment: str = "") -> LandingTable:
        """Write ``df`` as a new physical table, with the same layout and its own schema."""
        base, _, version = self.physical.rpartition("__v")
        fresh = replace(self, physical=f"{base}__v{int(version) + 1}", load_id=self.load_id + 1, retired=self.physical)
        spark.sql(f"DROP TABLE IF EXISTS {quoted_table(fresh.physical)}")
        fresh._make(spark, schema, comment)
        fresh._laid_out(spark, df, F.lit(fresh.load_id)).write.insertInto(fresh.physical)
        return fresh

    def match(self, spark: SparkSession, source: DataFrame, keys: Sequence[str]) -> KeyMatch:
        """The one pass over the table's keys that conflicts, touched partitions and the merge itself are read off.

        Only key columns of rows between the source's smallest and largest key are read, and what matches is staged.
        """
        rows, keys = shared_rows(self._data(spark), source, keys)
        near = self.rows(spark).filter(key_range(rows, keys))
        path = scratch_path(spark, "matches")
        found = key_matches(near, rows, keys, self.part)
        found.write.parquet(path)
        return KeyMatch(spark.read.schema(found.schema).parquet(path), path, tuple(keys))

    def _data(self, spark: SparkSession) -> T.StructType:
        return T.StructType([f for f in spark.table(self.physical).schema.fields if f.name not in (LOAD_ID, self.part)])

    def merge(
        self,
        spark: SparkSession,
        source: DataFrame,
        keys: Sequence[str],
        only_if_newer: bool = False,
        match: KeyMatch | None = None,
    ) -> LandingTable:
        """Stage the upsert of a staged source, ready to publish.

        Only partitions that hold a matched key are read whole and replaced. Rows for other partitions are added to
        them. ``match`` takes what :meth:`match` found for the same source.
        """
        columns = self._data(spark).fieldNames()
        merge_columns(columns, source.columns, keys)
        match = match or self.match(spark, source, keys)
        touched = [r[0] for r in match.frame.select(self._text()).distinct().collect()]
        target = self.rows(spark).filter(self._in(touched)).select(*[F.col(quoted(c)) for c in columns], LOAD_ID)
        matched = match.frame.select(*[F.col(quoted(k)) for k in match.keys]).distinct()
        merged = upsert(target, source, keys, only_if_newer, matched)
        load = F.lit(self.load_id + 1)
        # rows that stay among replaced ones keep their load; what comes to other partitions shows when published
        out = self._laid_out(spark, merged, F.col(LOAD_ID))
        out = out.withColumn(LOAD_ID, F.when(self._in(touched), F.coalesce(F.col(LOAD_ID), load)).otherwise(load))
        path = scratch_path(spark, "merged")
        out.withColumn("__part", F.col(self.part).cast("string")).write.partitionBy("__part").parquet(path)
        written = folder_values(spark, path, "__part")
        remove_folder(spark, match.path)
        return replace(self, load_id=self.load_id + 1, merge_of=Merge(path, tuple(sorted(touched)), tuple(sorted(written))))

    def _apply(self, spark: SparkSession, merge: Merge) -> None:
        """Write a staged upsert into the table: what is added first, then what is replaced, then drop what is empty."""
        self._note(spark, {"path": merge.path, "replaced": merge.replaced, "written": merge.written, "facts": dict(self.facts)})
        physical = spark.table(self.physical)
        schema = T.StructType([*physical.schema.fields, T.StructField("__part", T.StringType())])
        staged = spark.read.schema(schema).parquet(merge.path)
        for values, replaced in (([v for v in merge.written if v not in merge.replaced], False), ([v for v in merge.written if v in merge.replaced], True)):
            if values:
                rows = staged.filter(F.coalesce(F.col("__part"), F.lit(_NO_VALUE)).isin(*values)).drop("__part")
                rows.hint("rebalance", self.part).write.insertInto(self.physical, overwrite=replaced)
        self.drop_partitions(spark, [v for v in merge.replaced if v not in merge.written])

    def conflicts(self, spark: SparkSession, source: DataFrame, keys: Sequence[str]) -> DataFrame:
        """Keys that several source rows would update."""
        return self.match(spark, source, keys).conflicts()


def _unescape(value: str) -> str:
    return re.sub(r"%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)


def read_between(spark: SparkSession, name: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
    """Rows batched in ``[start, end)``, opening only the partitions that can hold them."""
    table = LandingTable.find(spark, name)
    if table is None:
        raise ValueError(f"no table {name}")
    at = F.col("_sdc_batched_at")
    low, high = (F.lit(t.isoformat()).cast("timestamp") for t in (start, end))
    pruned = table.rows(spark).filter(
        (F.col(table.part) >= partition_value(table.grain, low)) & (F.col(table.part) <= partition_value(table.grain, high))
    )
    return pruned.filter((at >= low) & (at < high)).select(*[quoted(c) for c in table.schema(spark).fieldNames()])


def expire_partitions(
    spark: SparkSession, name: str, days: int, as_of: dt.datetime
) -> list[str]:
    """Drop partitions whose period began ``days`` or more before ``as_of``.

    Planned from partition values in the catalog; no data is read. Returns the
    dropped values.
    """
    table = LandingTable.find(spark, name)
    if table is None:
        return []
    cutoff = as_of.replace(tzinfo=None) - dt.timedelta(days=days)
    old = [v for v in table.partitions(spark) if v != _NO_VALUE and dt.datetime.fromisoformat(v) <= cutoff]
    table.drop_partitions(spark, old)
    return sorted(old)


def compact(spark: SparkSession, name: str, at_least: int = 2) -> int:
    """Rewrite the partitions that ``at_least`` loads have written to in files of even size. Returns how many there were.

    A dynamic partition overwrite of the table from itself. One writer per table at a time, as for loads; queries that
    run meanwhile may find files gone.
    """
    found = LandingTable.find(spark, name)
    if found is None:
        raise ValueError(f"no table {name}")
    table = found.begin(spark)
    loads = table.rows(spark).groupBy(table._text().alias("value")).agg(F.count_distinct(LOAD_ID).alias("loads"))
    values = [r.value for r in loads.filter(F.col("loads") >= at_least).select("value").collect()]
    if values:
        rows = spark.table(table.physical).filter(table._in(values))
        rows.hint("rebalance", table.part).write.insertInto(table.physical, overwrite=True)
    return len(values)


__all__ = [
    "KeyMatch", "LandingTable", "cluster_layout", "compact", "expire_partitions", "expire_staging", "folder_values",
    "partition_column", "partition_value", "read_between", "staged_at", "staging_name",
]
